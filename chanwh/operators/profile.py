"""Profiles and duplicate reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F



def raw_profile(raw: DataFrame) -> DataFrame:
    """Row count, distinct channels, date range of the raw message table."""
    return raw.agg(
        F.count(F.lit(1)).alias("total_messages"),
        F.count_distinct("channel_name").alias("unique_channels"),
        F.min("message_date").alias("earliest_date"),
        F.max("message_date").alias("latest_date"),
    )


def detection_profile(raw_det: DataFrame) -> DataFrame:
    """Row count and distinct channels / messages / categories of the raw detection table."""
    return raw_det.agg(
        F.count(F.lit(1)).alias("total_detections"),
        F.count_distinct("channel_name").alias("unique_channels"),
        F.count_distinct("message_id").alias("unique_messages"),
        F.count_distinct("image_category").alias("unique_categories"),
    )


def channel_counts(raw: DataFrame) -> DataFrame:
    """Posts per channel with first and last date, most active first."""
    return raw.groupBy("channel_name").agg(
        F.count(F.lit(1)).alias("message_count"),
        F.min("message_date").alias("first_message"),
        F.max("message_date").alias("last_message"),
    ).orderBy(F.desc("message_count"), F.asc_nulls_first("channel_name"))


def _joined(values: str) -> F.Column:
    return F.array_join(F.array_sort(F.collect_set(values)), ", ")


def dup_mart(fct: DataFrame, dc: DataFrame) -> DataFrame:
    """Message ids repeated in the message fact, with their distinct channel keys and names.

    Rows are first counted per (id, channel), so a heavily repeated id costs one row per
    channel, not one per copy. A list has one entry per channel that uses the id: it grows with the
    number of channels, as the report does.
    """
    pairs = fct.groupBy("message_id", "channel_key").agg(F.count(F.lit(1)).alias("n"))
    named = pairs.join(dc.select("channel_key", "channel_name"), "channel_key")
    ids = named.groupBy("message_id").agg(F.sum("n").alias("count"), _joined("channel_key").alias("channel_keys"), _joined("channel_name").alias("channel_names"))
    return ids.where(F.col("count") > 1).orderBy(F.desc("count"), F.asc("message_id"))


def dup_raw(raw: DataFrame, top: int = 10) -> DataFrame:
    """(message_id, channel) loaded more than once, with their date span; top ``top``."""
    g = raw.groupBy("message_id", "channel_name").agg(
        F.count(F.lit(1)).alias("count"),
        F.min("message_date").alias("first_date"),
        F.max("message_date").alias("last_date"),
    ).where(F.col("count") > 1)
    return g.orderBy(F.desc("count"), F.asc_nulls_first("message_id"), F.asc_nulls_first("channel_name")).limit(top)


def dup_cross_channel(raw: DataFrame, top: int = 10) -> DataFrame:
    """Ids present in more than one channel; top ``top`` by number of channels. The ids are
    chosen by their counts; only those have their channels listed."""
    pairs = raw.where(F.col("channel_name").isNotNull()).select("message_id", "channel_name").distinct()
    order = [F.desc("channel_count"), F.asc_nulls_first("message_id")]
    ids = (pairs.groupBy("message_id").agg(F.count(F.lit(1)).alias("channel_count"))
           .where(F.col("channel_count") > 1).orderBy(*order).limit(top).withColumnRenamed("message_id", "_id"))
    listed = pairs.join(F.broadcast(ids), F.col("message_id").eqNullSafe(F.col("_id")))     # ``top`` rows
    return listed.groupBy("message_id", "channel_count").agg(_joined("channel_name").alias("channels")).orderBy(*order)


def layer_counts(tables: dict[tuple[str, str], DataFrame | None]) -> DataFrame:
    """Every expected table of every layer, whether it is there, and its exact row count, as one
    union of aggregates. None stands for a table that is missing."""
    spark = next(df for df in tables.values() if df is not None).sparkSession
    parts = [(df.agg(F.count(F.lit(1)).alias("row_count")) if df is not None
              else spark.range(1).select(F.lit(None).cast("bigint").alias("row_count")))
             .select(F.lit(layer).alias("layer"), F.lit(name).alias("table_name"),
                     F.lit("missing" if df is None else "present").alias("status"), "row_count")
             for (layer, name), df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def ingest_summary(raw: DataFrame, resolved: DataFrame, as_of=None) -> DataFrame:
    """Per configured channel — partition dates, messages, images posted, the image cap and the
    images within it — and one row of totals, whose ``config_channel`` is NULL.

    ``resolved`` is the output of ``channels.resolve_channels``: several display names of one
    configured channel share its cap. A message without a date is filed under ``as_of`` (default
    today), as the lake writer does.
    """
    day = F.coalesce(F.to_date("message_date"),
                     F.current_date() if as_of is None else F.lit(str(as_of)).cast("date"))
    has_img = F.coalesce(F.col("image_path") != "", F.lit(False))
    caps = resolved.select("channel_name", "config_channel", "max_images")
    rows = raw.select("channel_name", day.alias("day"), has_img.alias("img")).join(caps, "channel_name", "left")
    # days are counted from one row per channel and day
    days = rows.groupBy(F.coalesce("config_channel", "channel_name").alias("config_channel"), "day").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("img").alias("images"), F.max("max_images").alias("cap"))
    per = days.groupBy("config_channel").agg(
        F.lit(1).cast("bigint").alias("channels"), F.count(F.lit(1)).alias("total_dates"), F.sum("n").alias("total_messages"),
        F.sum("images").alias("images_posted"), F.max("cap").cast("bigint").alias("max_images"))
    per = per.withColumn("images_within_cap", F.least("images_posted", "max_images")).where(F.col("config_channel").isNotNull())
    dates = days.where(F.col("config_channel").isNotNull()).agg(F.count_distinct("day").alias("d")).scalar()
    total = per.agg(F.count(F.lit(1)).alias("channels"), F.sum("total_messages").alias("total_messages"), F.sum("images_posted").alias("images_posted"),
                    F.sum("max_images").alias("max_images"), F.sum("images_within_cap").alias("images_within_cap"))
    total = total.select(F.lit(None).cast("string").alias("config_channel"), "channels", dates.alias("total_dates"),
                         *(F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in ("total_messages", "images_posted")), "max_images", "images_within_cap")
    return per.unionByName(total)


def lake_channel_counts(records: DataFrame) -> DataFrame:
    """Posts per channel straight from the message lake (``scan_message_lake`` output),
    most active first. Records without a channel name are not counted."""
    return (records.where(F.col("channel_name").isNotNull())
            .groupBy("channel_name").agg(F.count(F.lit(1)).alias("message_count"))
            .orderBy(F.desc("message_count"), F.asc("channel_name")))
