"""Loads: first-wins dedupe (W2), insert-or-skip (S6, S7, J13), lake writer (S8),
detection CSV writer (S11), API record shaping (S12)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chanwh import schemas as S
from chanwh.functions import exprs as X
from chanwh.sources.commits import RECORDS_PER_FILE, CommittedTable
from chanwh.sources.lake import parse_lake_text
from chanwh.sources.tables import files_if_present, partition_values, staged


DAY_PARTITION = "dt"
#: Detections are stored by a hash of their key in so many partitions.
BUCKET_PARTITION, KEY_BUCKETS = "bucket", 256
#: The raw tables as they are stored: by message day, and by that hash.
STORED_MESSAGES = T.StructType([*S.RAW_MESSAGES.fields, T.StructField(DAY_PARTITION, T.DateType())])
STORED_DETECTIONS = T.StructType([*S.RAW_DETECTIONS.fields, T.StructField(BUCKET_PARTITION, T.IntegerType())])


def message_table(spark: SparkSession, target: str) -> CommittedTable:
    """The raw message table at ``target``."""
    return CommittedTable(spark, target, STORED_MESSAGES, DAY_PARTITION)


def detection_table(spark: SparkSession, target: str) -> CommittedTable:
    """The raw detection table at ``target``."""
    return CommittedTable(spark, target, STORED_DETECTIONS, BUCKET_PARTITION)


def with_day_partition(df: DataFrame, date_col: str = "message_date") -> DataFrame:
    """Add the day partition column of a raw table (written with ``partitionBy('dt')``)."""
    return df.withColumn(DAY_PARTITION, F.to_date(date_col))


def _any_null(keys: list[str]):
    cond = None
    for k in keys:
        c = F.col(k).isNull()
        cond = c if cond is None else (cond | c)
    return cond


def with_key_bucket(df: DataFrame) -> DataFrame:
    """Add the key-hash partition column of the raw detection table."""
    return df.withColumn(BUCKET_PARTITION, F.pmod(F.xxhash64("channel_name", "message_id"), F.lit(KEY_BUCKETS)).cast("int"))


def dedupe_first(batch: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per non-NULL key, the first by ``order``; rows with a NULL key all pass
    (NULLs are distinct, as in the target's unique constraint).

    ``min_by`` is a partial aggregate: each map task keeps one row per key before the
    shuffle, so a key repeated across a third of the batch still costs one row per task. A row
    with a NULL key gets a number of its own, so the batch is evaluated once.
    """
    cols = batch.columns
    rows = batch.withColumn("_own", F.when(_any_null(keys), F.monotonically_increasing_id()))
    return rows.groupBy(*keys, "_own").agg(F.min_by(F.struct(*cols), F.struct(*order)).alias("_r")).select("_r.*")


def insert_or_skip(target: DataFrame, batch: DataFrame, keys: list[str], order: list[str],
                   reject_null_keys: bool = False, prune: dict[str, list | None] | None = None) -> DataFrame:
    """The batch rows to append — first-wins within the batch, existing rows win
    over the batch (never updated). ``reject_null_keys`` drops NULL-key rows (NOT NULL keys, S7);
    otherwise they are all appended (a NULL key never equals a stored key).

    The batch is evaluated once. ``prune`` names partition columns of the target and the
    values that the batch has there (``partition_values``): only those partitions are read, so one
    late row adds its own day, not every day since.
    """
    rows = batch.where(~_any_null(keys)) if reject_null_keys else batch
    t = target
    for column, values in (prune or {}).items():
        if values is not None:
            t = t.where(F.col(column).isin(values))
    new = dedupe_first(rows, keys, order).join(t.select(*keys), keys, "left_anti")
    return new.drop(*[c for c in order if c not in target.columns])


# ---------------------------------------------------------------------------
# S8 lake writer
# ---------------------------------------------------------------------------
def lake_partition(as_of=None) -> list:
    """(dt, channel) of a lake record: its message day (no date → ``as_of``, default today)
    as 'YYYY-MM-DD' and its file-safe channel name."""
    today = F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")
    day = F.date_format(F.coalesce(F.to_date(X.parse_timestamp("message_date")), today), "yyyy-MM-dd")
    return [day.alias("dt"), X.safe_file_name("channel_name").alias("channel")]


#: A file of the lake's other form: a JSON array (or one record) for a day and a channel.
ARRAY_FILE = r"/(\d{4}-\d{2}-\d{2})/([^/]+)\.json$"


def stored_ids(spark: SparkSession, path: str, days: list | None) -> DataFrame:
    """(dt, channel, id) of the records in the lake at ``path``, of the given days if any are given: JSON Lines
    under ``dt=.../channel=...`` as well as array files ``YYYY-MM-DD/<channel>.json``. No lake: no rows."""
    lines = files_if_present(lambda: spark.read.schema("message_id string, dt string, channel string").option("basePath", path).json(f"{path.rstrip('/')}/dt=*"))
    arrays = files_if_present(lambda: spark.read.text(path, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.json"))
    found = spark.createDataFrame([], "dt string, channel string, id string")
    if lines is not None:
        own = lines if days is None else lines.where(F.col("dt").isin(days))
        found = found.unionByName(own.select("dt", "channel", F.col("message_id").alias("id")))
    if arrays is not None:
        file = F.url_decode(F.regexp_replace(F.col("_metadata.file_path"), r"\+", "%2B"))
        day = F.regexp_extract(file, ARRAY_FILE, 1)
        texts = arrays.where(day != "" if days is None else day.isin(days)).select("value", F.col("_metadata.file_path").alias("_file"))
        file = F.url_decode(F.regexp_replace(F.col("_file"), r"\+", "%2B"))
        records = parse_lake_text(texts).select(F.regexp_extract(file, ARRAY_FILE, 1).alias("dt"), F.regexp_extract(file, ARRAY_FILE, 2).alias("channel"), F.col("message_id").alias("id"))
        found = found.unionByName(records)
    return found


def lake_additions(rows: DataFrame, stored: DataFrame) -> DataFrame:
    """Of rows(dt, channel, message_id, ...) those whose id their day and channel don't have yet (``stored``: dt, channel, id
    as text); repeats among the rows all stay, and so do rows without an id."""
    return rows.join(stored, (rows["dt"] == stored["dt"]) & (rows["channel"] == stored["channel"]) & (rows["message_id"].cast("string") == stored["id"]), "left_anti")


def write_message_lake(df: DataFrame, path: str, merge: bool = False, as_of=None) -> int:
    """File message records by day (no date → ``as_of``, default today) and file-safe
    channel name as JSON Lines under ``dt=YYYY-MM-DD/channel=<safe name>/``; returns how many.

    With ``merge``, a record whose id is already stored in the same day/channel partition is
    skipped (the stored record wins; repeats inside the batch are kept); only the batch's days
    are read. Stored records may also be in array files, a file for a day and a channel; a lake that does
    not exist yet is created. Rows are gathered by partition before they are written, so that a partition gets
    few files, with a bound on a file's records.
    """
    rows = df.select(*[F.col(c) for c in df.columns], *lake_partition(as_of))
    spark = df.sparkSession
    if merge:
        rows = lake_additions(rows, stored_ids(spark, path, partition_values(rows, "dt")))
    # staged beside the lake: the join reads the lake, which the write then adds to
    with staged(rows, path) as ready:
        seen = Observation()
        gathered = ready.hint("rebalance", "dt", "channel").observe(seen, F.count(F.lit(1)).alias("rows"))
        gathered.write.mode("append").option("maxRecordsPerFile", RECORDS_PER_FILE).partitionBy("dt", "channel").json(path)
        return seen.get["rows"]


# ---------------------------------------------------------------------------
# S11 detection CSV writer
# ---------------------------------------------------------------------------
#: Spark's CSV writer would trim the fields.
CSV_KEEPS_SPACES = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def write_detections_csv(df: DataFrame, path: str) -> None:
    """Fixed field order, missing fields written as empty strings, header line; spaces of a field stay."""
    cols = [(F.col(f).cast("string") if f in df.columns else F.lit(None).cast("string")).alias(f)
            for f in S.DETECTION_CSV_FIELDS]
    df.select(*cols).na.fill("").write.mode("overwrite").options(header=True, **CSV_KEEPS_SPACES).csv(path)


# ---------------------------------------------------------------------------
# S12 record shaping
# ---------------------------------------------------------------------------
def shape_message_records(api: DataFrame, scraped_at: _dt.datetime | None = None) -> DataFrame:
    """API message rows → lake records.

    api(id, channel_name, date, text, media_type, views, forwards, is_reply, reply_to_msg_id);
    ``date`` is the message time (timestamp, or timestamp_ntz already in UTC). media_type is
    NULL without media; a photo gets ``data/raw/images/<channel>/<id>.jpg``. Dates are
    written as ISO text with '+00:00'; ``scraped_at`` (default now) without an offset.
    """
    date = F.col("date")
    if dict(api.dtypes)["date"] == "timestamp":
        date = F.convert_timezone(F.current_timezone(), F.lit("UTC"), date.cast("timestamp_ntz"))
    ts = F.current_timestamp().cast("timestamp_ntz") if scraped_at is None else F.lit(scraped_at).cast("timestamp_ntz")
    is_photo = F.coalesce(F.col("media_type") == "photo", F.lit(False))
    return api.select(
        F.col("id").alias("message_id"),
        "channel_name",
        X.iso_text(date, utc_suffix=True).alias("message_date"),
        F.coalesce("text", F.lit("")).alias("message_text"),
        F.col("media_type").isNotNull().alias("has_media"),
        F.when(is_photo, F.concat(F.lit("data/raw/images/"), F.col("channel_name"), F.lit("/"),
                                  F.col("id").cast("string"), F.lit(".jpg"))).alias("image_path"),
        F.coalesce("views", F.lit(0)).alias("views"),
        F.coalesce("forwards", F.lit(0)).alias("forwards"),
        "is_reply",
        F.when(F.col("is_reply"), F.col("reply_to_msg_id")).alias("reply_to_msg_id"),
        X.iso_text(ts).alias("scraped_at"),
    )
