"""Incremental ingest of newly dropped lake files with Structured Streaming.

A file source watches the message lake; each micro-batch is parsed (S1), coerced (S3),
de-duplicated first-wins and appended with insert-or-skip against the target table (S6).
Stateless by design: duplicates are resolved against the target, so no watermark is
needed and data of any lateness is accepted. ``availableNow`` processes what is there
and stops, which makes a daily run idempotent. A micro-batch is one commit of the target
(``sources.commits``) under its number, so a run that dies at any point adds its rows once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chanwh import schemas as S
from chanwh.operators.load import DAY_PARTITION, insert_or_skip, message_table, with_day_partition
from chanwh.sources.coerce import coerce_messages
from chanwh.sources.lake import parse_lake_text
from chanwh.sources.tables import partition_values, staged


def append_messages(spark: SparkSession, records: DataFrame, target: str, batch: str | None = None) -> int:
    """Insert-or-skip of coerced records into the raw message table at ``target`` (any URI) as one commit;
    returns the rows added. The records are parsed once, into a staging table beside the target; only
    the target's days that the batch has are read, and nothing of it is counted."""
    table = message_table(spark, target)
    with staged(records, target) as rows:
        new = insert_or_skip(table.read(), rows, S.RAW_MESSAGES_KEY, ["_file", "_pos"],
                             prune={DAY_PARTITION: partition_values(rows, F.to_date("message_date"))})
        # gathered by day: few files for each, however many tasks the batch has
        return table.append(with_day_partition(new), batch)


def progress_folder(target: str) -> str:
    """Where the progress of the ingest into ``target`` is kept: beside it, so that it outlives the
    application and two targets never share it."""
    return target.rstrip("/") + "_progress"


def ingest_increment(spark: SparkSession, source: str, target: str, checkpoint: str | None = None,
                     max_files_per_trigger: int | None = None) -> None:
    """Run the incremental ingest until every file present in ``source`` is processed. A batch is committed
    under the stream's id and its number: one that Spark runs again is found in the manifest, or, if it
    died before, starts afresh, so that rows without a date (whose key never equals a stored one) are
    not added twice either."""
    checkpoint = checkpoint or progress_folder(target)
    reader = (spark.readStream.format("text").option("wholetext", True)
              .option("recursiveFileLookup", True).option("pathGlobFilter", "*.json"))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    # the file path must be selected on the stream itself: _metadata is not resolvable inside foreachBatch
    files = reader.load(source).select("value", F.col("_metadata.file_path").alias("_file"))

    def each(batch: DataFrame, epoch_id: int) -> None:
        session = batch.sparkSession
        # the stream's own id, which it writes into its checkpoint before the first batch
        stream = session.read.schema("id string").json(checkpoint.rstrip("/") + "/metadata").first()["id"]
        name = f"{stream}-{epoch_id}"
        if not message_table(session, target).has(name):
            append_messages(session, coerce_messages(parse_lake_text(batch)), target, name)

    q = (files.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
