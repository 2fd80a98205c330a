"""Parquet tables that grow by commits: a batch is written into a folder of its own and becomes visible
by one manifest entry.

``<path>/batch=<id>/`` holds a batch, ``<path>_manifest/`` one row for each commit: the batch's id, its rows,
and the batches that it replaces. Readers list the folders of committed batches only, so what a killed
load left behind is never seen, and a load that runs again under the same id starts its folder
afresh and is published once. An entry is a file of one row, which Spark's committer renames into place.

A table has one writer at a time (the daily load); any number may read meanwhile.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chanwh.sources.tables import table_if_present

MANIFEST = "batch string, rows bigint, replaces array<string>"
#: Upper bound on the records of one written file.
RECORDS_PER_FILE = 2_000_000


class CommittedTable:
    """The table at ``path`` (any URI) with columns ``schema``, stored by the column ``partition``."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, partition: str):
        self.spark, self.path, self.schema, self.partition = spark, path.rstrip("/"), schema, partition

    def manifest(self) -> DataFrame | None:
        return table_if_present(self.spark, self.path + "_manifest", MANIFEST)

    def commits(self) -> dict[str, int]:
        """Rows of the batches that make up the table; a commit is one load, so they are few."""
        entries = self.manifest()
        entries = [] if entries is None else entries.distinct().collect()
        gone = {b for e in entries for b in e["replaces"]}
        return {e["batch"]: e["rows"] for e in entries if e["batch"] not in gone}

    def exists(self) -> bool:
        return self.manifest() is not None

    def has(self, batch: str) -> bool:
        """Whether the batch was committed, even if another one has replaced it since."""
        entries = self.manifest()
        return entries is not None and not entries.where(F.col("batch") == batch).isEmpty()

    def rows(self) -> int:
        """Rows of the table, from the manifest: nothing of the table is read."""
        return sum(self.commits().values())

    def read(self) -> DataFrame:
        """The committed rows; an empty table if nothing was committed."""
        found = sorted(b for b, n in self.commits().items() if n)
        if not found:
            return self.spark.createDataFrame([], self.schema)
        stored = T.StructType([*self.schema.fields, T.StructField("batch", T.StringType())])
        paths = [f"{self.path}/batch={b}" for b in found]
        return self.spark.read.schema(stored).option("basePath", self.path).parquet(*paths).drop("batch")

    def stage(self, rows: DataFrame, batch: str) -> int:
        """Write a batch, not visible yet; what an earlier attempt left is overwritten. Returns its rows, which are
        counted as they are written, in the last stage, whose tasks count once."""
        seen = Observation()
        gathered = rows.select(*self.schema.fieldNames()).hint("rebalance", self.partition).observe(seen, F.count(F.lit(1)).alias("rows"))
        (gathered.write.mode("overwrite").option("maxRecordsPerFile", RECORDS_PER_FILE).partitionBy(self.partition)
         .parquet(f"{self.path}/batch={batch}"))
        return seen.get["rows"]

    def publish(self, batch: str, rows: int, replaces: list[str] | None = None) -> None:
        entry = self.spark.createDataFrame([(batch, rows, replaces or [])], MANIFEST)
        entry.coalesce(1).write.mode("append").parquet(self.path + "_manifest")

    def append(self, rows: DataFrame, batch: str | None = None) -> int:
        """Add a batch, of an own new id by default; a batch that was committed already is left as it is
        and adds nothing. Returns the rows added."""
        batch = batch or uuid.uuid4().hex
        if self.has(batch):
            return 0
        added = self.stage(rows, batch)
        self.publish(batch, added)
        return added

    def compact(self) -> int:
        """Rewrite all batches as one and publish it in their place; returns how many there were. Readers
        that began before go on reading the old folders, which are left in place."""
        old = self.commits()
        if len(old) > 1:
            batch = uuid.uuid4().hex
            self.publish(batch, self.stage(self.read(), batch), sorted(old))
        return len(old)
