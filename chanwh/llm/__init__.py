"""Operators of a training-data pipeline; one module per operator, queries in ``queries``."""

import sys

from pyspark import cloudpickle

# what runs in Python workers travels with the plan, so that executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
