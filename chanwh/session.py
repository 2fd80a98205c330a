"""Session for tests and the bench."""

from __future__ import annotations

from pyspark.sql import SparkSession


def get_spark(master: str | None = None, app: str = "chanwh", shuffle_partitions: int = 8) -> SparkSession:
    """Local session for tests and the bench. On a cluster use the cluster's session as is."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # call-site capture for error messages costs Py4J round trips on every Column
        # function call while a plan is built; off for batch runs
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
