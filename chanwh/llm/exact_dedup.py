"""Exact dedup against a persistent digest index.

The index is a Parquet table bucketed and sorted by digest with one row per distinct text. A
batch of new rows is first reduced to one row per digest, then joined to the index by a
sort-merge anti-join (the index side is read bucket by bucket, without a shuffle or a sort), and
the digests that are new are appended. Copies are counted by a map-side aggregation, so a text
that a third of all rows share is one row per task before anything is shuffled.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chanwh.llm.shared import ascii_lower, new_path, partitions, text_or_empty, written


def digest(text_col: str):
    """SHA-256 of the text in UTF-8 after lower-casing A-Z; null counts as empty."""
    return F.sha2(ascii_lower(text_or_empty(text_col)), 256)


class DigestIndex:
    """The persistent index: ``digest`` -> ``keep_id``, the row that stays of each distinct text.

    ``path`` may hold an index of an earlier application; the table is then registered again from
    its files. An append is one committed Spark job, and a batch that runs again after a failure
    finds its own digests and changes nothing.
    """

    SCHEMA = "digest string, keep_id {id_type}"

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int | None = None, id_type: str = "bigint"):
        self.spark, self.path = spark, path or new_path(spark, "digest-index")
        self.buckets = buckets or partitions(spark)
        self.name = f"llm_digest_index_{uuid.uuid4().hex[:12]}"
        spark.sql(f"CREATE TABLE {self.name} ({self.SCHEMA.format(id_type=id_type)}) USING parquet "
                  f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{self.path}'")

    def table(self) -> DataFrame:
        return self.spark.table(self.name)

    def append_new(self, firsts: DataFrame) -> None:
        """Add the rows of ``firsts`` (digest, keep_id; one per digest) whose digest is not indexed."""
        fresh = firsts.hint("merge").join(self.table(), "digest", "left_anti").select("digest", "keep_id")
        (fresh.repartition(self.buckets, "digest").write.mode("append").format("parquet")
         .bucketBy(self.buckets, "digest").sortBy("digest").option("path", self.path).saveAsTable(self.name))


def deduplicate(docs: DataFrame, index: DigestIndex | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Judge a batch against ``index`` (default: a new, empty one) and add what is new to it.

    One row per row of ``docs``: id, ``keep_id``, ``group_size`` (rows of this batch with the
    same text), ``kept``, ``text_sha256``. Of equal texts the row with the largest id stays, or
    the one that the index had already. Null texts are empty texts; null ids come last; of
    repeated rows with the same id and text exactly one is kept. No rows: an empty result.
    """
    spark = docs.sparkSession
    base = written(docs.select(F.col(id_col).alias("id"), digest(text_col).alias("digest"), F.monotonically_increasing_id().alias("row")), "digests")
    index = index or DigestIndex(spark, id_type=base.schema["id"].dataType.simpleString())
    groups = base.groupBy("digest").agg(F.max("id").alias("keep_id"), F.max_by("row", F.struct("id", "row")).alias("keep_row"), F.count(F.lit(1)).alias("group_size"))
    groups = written(groups, "groups")
    index.append_new(groups)
    # the index now has every digest of the batch
    entries = groups.drop("keep_id").hint("merge").join(index.table().hint("merge"), "digest")
    entries = written(entries, "entries")
    # a unique key on one side and two plain exchanges: a hot text adds no rows, and adaptive
    # execution may split its partition
    rows = base.join(entries.hint("merge"), "digest")
    return rows.select(F.col("id").alias(id_col), "keep_id", "group_size",
                       (F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("row") == F.col("keep_row"))).alias("kept"),
                       F.col("digest").alias("text_sha256"))
