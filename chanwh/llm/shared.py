"""Helpers of the training-data operators: the shared folder, written steps, input columns."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` of the session. A folder of our own serves
    only where it is unset and Spark runs in one process (tests), never on a cluster."""
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if not conf:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        conf = local_folder()
    return conf.rstrip("/")


@functools.cache
def local_folder() -> str:
    """The folder of a session in one process that names none: the same for its whole life."""
    return "file://" + tempfile.mkdtemp(prefix="chanwh-llm-")


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{shared_folder(spark)}/llm/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: computed once, its lineage cut, and still
    there after executors are lost."""
    path = new_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_or_empty(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def ascii_lower(c: Column) -> Column:
    """A-Z only; every other character stays as it is."""
    return F.translate(c, UPPER, UPPER.lower())


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


#: Rows of a narrow side (ids and hashes, under 300 bytes each in memory) that may be broadcast.
BROADCAST_ROWS = 200_000


def small(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """A written table, broadcast if it has at most ``most`` rows; else Spark chooses the join."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def keep_rows(docs: DataFrame, decisions: DataFrame, key: Column, id_col: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that ``decisions`` keep, with all their columns. A decision (id, key, kept) stands
    for one row; ``key`` is what an operator can tell about a row besides its id. Of rows that are
    the same to the operator and of which it keeps some but not all, one stays."""
    # written first: what decided by key is not taken together by key again, so its join can be split
    per = written(decisions, "judged").groupBy("id", "key").agg(F.count(F.lit(1)).alias("n"), F.count_if("kept").alias("k")).where("k < n")
    per = written(per.select(F.col("id").alias("__llm_id"), F.col("key").alias("__llm_key"), F.col("k").alias("__llm_kept")), "decisions")
    marked = docs.withColumn("__llm_own", key)
    marked = marked.join(small(per), marked[id_col].eqNullSafe(per["__llm_id"]) & (marked["__llm_own"] == per["__llm_key"]), "left")
    stay = marked.where(F.col("__llm_kept").isNull())
    if not per.where("__llm_kept > 0").isEmpty():
        stay = stay.unionByName(marked.where(F.col("__llm_kept") > 0).dropDuplicates([id_col, "__llm_own"]))
    return stay.select(*(stay[f"`{c}`"] for c in docs.columns))
