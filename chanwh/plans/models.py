"""Star-schema models: staging (M1, M2), dimensions (M3, M4), facts (M5, M6), build.

All models are lazy plans; a build writes dimensions and facts as Parquet.
"""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chanwh import schemas as S
from chanwh.functions import exprs as X
from chanwh.operators.load import detection_table, message_table
from chanwh.operators.profile import layer_counts
from chanwh.plans.search_index import build_search_index
from chanwh.sources.commits import RECORDS_PER_FILE
from chanwh.sources.tables import table_if_present


# ---------------------------------------------------------------------------
# Staging
# ---------------------------------------------------------------------------
def stg_messages(raw: DataFrame) -> DataFrame:
    """M1: critical-NULL filter, blank-text filter, defaults, length, has_image, day."""
    r = raw.where(F.col("message_id").isNotNull() & F.col("channel_name").isNotNull()
                  & F.col("message_date").isNotNull())
    r = r.where(F.col("message_text").isNotNull() & (F.length(F.trim("message_text")) > 0))
    text = F.coalesce(F.col("message_text"), F.lit(""))
    path = F.col("image_path")
    return r.select(
        F.col("message_id").cast("bigint").alias("message_id"),
        X.varchar(F.trim("channel_name"), X.CHANNEL_WIDTH).alias("channel_name"),
        F.col("message_date").cast("timestamp_ntz").alias("message_date"),
        F.to_date("message_date").alias("message_date_only"),
        text.alias("message_text"),
        F.length(text).cast("int").alias("message_length"),
        F.coalesce(F.col("has_media"), F.lit(False)).alias("has_media"),
        X.varchar(F.coalesce(path, F.lit("")), X.PATH_WIDTH).alias("image_path"),
        (path.isNotNull() & (path != "")).alias("has_image"),
        F.coalesce(F.col("views"), F.lit(0)).cast("int").alias("view_count"),
        F.coalesce(F.col("forwards"), F.lit(0)).cast("int").alias("forward_count"),
        F.coalesce(F.col("is_reply"), F.lit(False)).alias("is_reply"),
        F.col("reply_to_msg_id").cast("bigint").alias("reply_to_msg_id"),
        F.col("scraped_at").cast("timestamp_ntz").alias("scraped_at"),
        F.col("loaded_at").cast("timestamp_ntz").alias("loaded_at"),
    )


def stg_detections(raw: DataFrame) -> DataFrame:
    """M2: NULL and blank-channel filter, defaults, category normalised."""
    r = raw.where(F.col("message_id").isNotNull() & F.col("channel_name").isNotNull()
                  & (F.length(F.trim("channel_name")) > 0))
    return r.select(
        F.col("message_id").cast("bigint").alias("message_id"),
        X.varchar(F.trim("channel_name"), X.CHANNEL_WIDTH).alias("channel_name"),
        X.varchar(F.coalesce(F.col("image_path"), F.lit("")), X.PATH_WIDTH).alias("image_path"),
        F.coalesce(F.col("detected_classes"), F.lit("")).alias("detected_classes"),
        F.coalesce(F.col("total_detections"), F.lit(0)).cast("int").alias("total_detections"),
        F.coalesce(F.col("max_confidence").cast("decimal(5,4)"), F.lit(0).cast("decimal(5,4)")).alias("max_confidence"),
        X.normalize_category("image_category").alias("image_category"),
        F.col("processed_at").cast("timestamp_ntz").alias("processed_at"),
        F.col("loaded_at").cast("timestamp_ntz").alias("loaded_at"),
    )


# ---------------------------------------------------------------------------
# Dimensions
# ---------------------------------------------------------------------------
def dim_channels(stg: DataFrame) -> DataFrame:
    """M3: one row per channel. The reference's same-key self-join is a projection here."""
    stats = stg.groupBy("channel_name").agg(
        F.min("message_date_only").alias("first_post_date"),
        F.max("message_date_only").alias("last_post_date"),
        F.count(F.lit(1)).alias("total_posts"),
        F.sum("view_count").alias("_views"),
        F.sum(F.when(F.col("has_image"), 1).otherwise(0)).cast("bigint").alias("total_images"),
    )
    return stats.select(
        X.surrogate_key("channel_name").alias("channel_key"),
        "channel_name",
        X.channel_type("channel_name").alias("channel_type"),
        "first_post_date", "last_post_date", "total_posts",
        X.avg_dec2("_views", "total_posts").alias("avg_views"),
        "total_images",
        X.pct("total_images", "total_posts").alias("image_percentage"),
    )


def dim_dates(stg: DataFrame) -> DataFrame:
    """M4: every calendar day from the first to the last message day; empty input → 0 rows."""
    bounds = stg.agg(F.min("message_date_only").alias("lo"), F.max("message_date_only").alias("hi"))
    days = bounds.select(F.explode(F.sequence("lo", "hi", F.expr("interval 1 day"))).alias("full_date"))
    d = F.col("full_date")
    return days.select(
        X.date_key(d).alias("date_key"),
        d.alias("full_date"),
        X.dow0(d).alias("day_of_week"),
        X.day_name(d).alias("day_name"),
        F.weekofyear(d).alias("week_of_year"),
        F.month(d).alias("month"),
        X.month_name(d).alias("month_name"),
        F.quarter(d).alias("quarter"),
        F.year(d).alias("year"),
        X.dow0(d).isin(0, 6).alias("is_weekend"),
        F.dayofmonth(d).alias("day_of_month"),
        F.dayofyear(d).alias("day_of_year"),
        F.date_format(d, "yyyy-MM").alias("year_month"),
    )


# ---------------------------------------------------------------------------
# Facts
# ---------------------------------------------------------------------------
FCT_MESSAGE_COLUMNS = ["message_id", "channel_key", "date_key", "message_text", "message_length",
                       "view_count", "forward_count", "has_image", "image_path", "is_reply",
                       "reply_to_msg_id", "message_date", "scraped_at", "loaded_at"]
FCT_DETECTION_COLUMNS = ["message_id", "channel_key", "date_key", "image_path", "detected_classes",
                         "total_detections", "max_confidence", "image_category", "view_count",
                         "forward_count", "message_date", "processed_at"]


def fct_messages(stg: DataFrame, dc: DataFrame, dd: DataFrame) -> DataFrame:
    """M5: messages × channel (J1) × date (J2), inner joins."""
    c = dc.select("channel_key", "channel_name")
    d = dd.select("date_key", F.col("full_date").alias("message_date_only"))
    return stg.join(c, "channel_name").join(d, "message_date_only").select(*FCT_MESSAGE_COLUMNS)


def fct_image_detections(stg_d: DataFrame, stg_m: DataFrame, dc: DataFrame, dd: DataFrame) -> DataFrame:
    """M6: detections × their message (J3) × channel × date. Detections without a surviving
    message are dropped, so caption-less photos vanish (kept reference behaviour)."""
    m = stg_m.select("message_id", "channel_name", "message_date", "message_date_only",
                     "view_count", "forward_count")
    dwm = stg_d.drop("loaded_at").join(m, ["message_id", "channel_name"])
    c = dc.select("channel_key", "channel_name")
    d = dd.select("date_key", F.col("full_date").alias("message_date_only"))
    return dwm.join(c, "channel_name").join(d, "message_date_only").select(*FCT_DETECTION_COLUMNS)


def keyed_messages(stg: DataFrame) -> DataFrame:
    """M5 without its joins, for dimensions of the same staging rows: those hold every channel and every
    day of them, and their keys are functions of the joined columns, so the inner joins keep every
    row and add only the keys."""
    keyed = stg.withColumns({"channel_key": X.surrogate_key("channel_name"), "date_key": X.date_key("message_date_only")})
    return keyed.select(*FCT_MESSAGE_COLUMNS)


def keyed_detections(stg_d: DataFrame, stg_m: DataFrame) -> DataFrame:
    """M6 likewise: only the join with the message is left."""
    m = stg_m.select("message_id", "channel_name", "message_date", "message_date_only", "view_count", "forward_count")
    keyed = stg_d.drop("loaded_at").join(m, ["message_id", "channel_name"]).withColumns(
        {"channel_key": X.surrogate_key("channel_name"), "date_key": X.date_key("message_date_only")})
    return keyed.select(*FCT_DETECTION_COLUMNS)


# ---------------------------------------------------------------------------
# Warehouse
# ---------------------------------------------------------------------------
@dataclass
class Warehouse:
    stg_messages: DataFrame
    stg_detections: DataFrame | None
    dim_channels: DataFrame
    dim_dates: DataFrame
    fct_messages: DataFrame
    fct_image_detections: DataFrame | None


def warehouse(raw_messages: DataFrame, raw_detections: DataFrame | None = None) -> Warehouse:
    """Staging, dimensions and facts as lazy plans. The facts carry their keys without joining the
    dimensions, which come from the same staging rows; reports join dimensions without a hint, and
    adaptive execution broadcasts them by their measured bytes."""
    sm = stg_messages(raw_messages)
    sd = fid = None
    if raw_detections is not None:
        sd = stg_detections(raw_detections)
        fid = keyed_detections(sd, sm)
    return Warehouse(sm, sd, dim_channels(sm), dim_dates(sm), keyed_messages(sm), fid)


def mart_schemas() -> dict[str, str]:
    """The marts' columns as they are written."""
    return {
        "dim_channels": "channel_key string, channel_name string, channel_type string, first_post_date date, last_post_date date, "
                        "total_posts bigint, avg_views decimal(10,2), total_images bigint, image_percentage double",
        "dim_dates": "date_key int, full_date date, day_of_week int, day_name string, week_of_year int, month int, month_name string, "
                     "quarter int, year int, is_weekend boolean, day_of_month int, day_of_year int, year_month string",
        "fct_messages": "message_id bigint, channel_key string, message_text string, message_length int, view_count int, forward_count int, "
                        "has_image boolean, image_path string, is_reply boolean, reply_to_msg_id bigint, message_date timestamp_ntz, "
                        "scraped_at timestamp_ntz, loaded_at timestamp_ntz, date_key int",
        "fct_image_detections": "message_id bigint, channel_key string, image_path string, detected_classes string, total_detections int, "
                                "max_confidence decimal(5,4), image_category string, view_count int, forward_count int, "
                                "message_date timestamp_ntz, processed_at timestamp_ntz, date_key int",
    }


def build_warehouse(spark: SparkSession, raw_messages: DataFrame, raw_detections: DataFrame | None,
                    out: str) -> dict[str, int]:
    """Staging as temp views, marts written as Parquet tables (full rebuild).

    Facts are partitioned by ``date_key`` (a look-back filter on the date dimension
    prunes partitions at run time — dynamic partition pruning) and clustered by
    ``channel_key`` inside each file, so per-channel reports skip row groups by min/max
    statistics. Rows are gathered by day before they are written (adaptive execution splits large
    days), so files are as many as days, not tasks x days. The facts are joined with the written
    dimensions, and the message fact's files get a trigram index for searches (``plans.search_index``).
    """
    sm = stg_messages(raw_messages)
    sm.createOrReplaceTempView("stg_channel_messages")
    schemas, counts = mart_schemas(), {}

    def store(name: str, df: DataFrame) -> DataFrame:
        path = os.path.join(out, "marts", name)
        w = df
        if name.startswith("fct_"):
            w = df.hint("rebalance", "date_key").sortWithinPartitions("date_key", "channel_key")
        writer = w.write.mode("overwrite").option("maxRecordsPerFile", RECORDS_PER_FILE)
        (writer.partitionBy("date_key") if name.startswith("fct_") else writer).parquet(path)
        back = spark.read.schema(schemas[name]).parquet(path)
        back.createOrReplaceTempView(name)
        counts[name] = back.count()
        return back

    dc, dd = store("dim_channels", dim_channels(sm)), store("dim_dates", dim_dates(sm))
    build_search_index(store("fct_messages", fct_messages(sm, dc, dd)), out)
    if raw_detections is not None:
        sd = stg_detections(raw_detections)
        sd.createOrReplaceTempView("stg_image_detections")
        store("fct_image_detections", fct_image_detections(sd, sm, dc, dd))
    return counts


def open_warehouse(spark: SparkSession, out: str) -> Warehouse:
    """The marts written by ``build_warehouse`` at ``out`` (a path or URI), ready for the reports: plain
    Parquet scans, so report filters are pushed into them (channel_key row-group skipping,
    date_key dynamic partition pruning) and small dimensions are broadcast by their size."""
    mart = {n: table_if_present(spark, os.path.join(out, "marts", n), s) for n, s in mart_schemas().items()}
    missing = [n for n in ("dim_channels", "dim_dates", "fct_messages") if mart[n] is None]
    if missing:
        raise FileNotFoundError(f"no {', '.join(missing)} under {out}")
    return Warehouse(None, None, mart["dim_channels"], mart["dim_dates"], mart["fct_messages"], mart["fct_image_detections"])


def layer_listing(spark: SparkSession, out: str) -> DataFrame:
    """A22 over a warehouse's folders: each raw table and mart that should be there, present or missing."""
    raw = {("raw", "channel_messages"): message_table(spark, os.path.join(out, "raw", "channel_messages")),
           ("raw", "image_detections"): detection_table(spark, os.path.join(out, "raw", "image_detections"))}
    found = {name: t.read() if t.exists() else None for name, t in raw.items()}
    found |= {("marts", n): table_if_present(spark, os.path.join(out, "marts", n), s) for n, s in mart_schemas().items()}
    if all(t is None for t in found.values()):
        raise FileNotFoundError(f"nothing under {out}")
    return layer_counts(found)
