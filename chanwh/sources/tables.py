"""Parquet tables by path, on any file system Spark reads: no local path is ever probed."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


@contextmanager
def staged(df: DataFrame, target: str) -> Iterator[DataFrame]:
    """``df`` written once beside ``target``, under a name of its own, and removed afterwards."""
    spark, path = df.sparkSession, f"{target.rstrip('/')}_staging-{uuid.uuid4().hex}"
    try:
        df.write.parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def table_if_present(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame | None:
    """The table at ``path``, or None if the path does not exist. The schema is given, as a table
    without rows may have no file to infer it from."""
    return files_if_present(lambda: spark.read.schema(schema).parquet(path))


def files_if_present(read: Callable[[], DataFrame]) -> DataFrame | None:
    """What ``read`` opens, or None if its path does not exist."""
    try:
        return read()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def partition_values(rows: DataFrame, column, most: int = 1000) -> list | None:
    """Distinct values of a partition expression over a batch, or None beyond ``most`` (then nothing
    is pruned). At most ``most`` values reach the driver."""
    found = [r[0] for r in rows.select(column).distinct().limit(most + 1).collect()]
    return None if len(found) > most else [v for v in found if v is not None]
