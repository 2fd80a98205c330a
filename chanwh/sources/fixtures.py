"""Adapter from the driver's test tables to this domain's input schemas (FIXTURES.md §2).

The driver's tables are not chat messages; these DataFrames give the message-lake and
detection schemas deterministically from them, over the whole tables. ``chanwh.oracle``
holds the same definitions in SQL for the DuckDB cross-check.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chanwh.functions import exprs as X


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def fixture_folder(message_id: Column) -> Column:
    """0 to 19: five ids in a row share one, so that documents (every fifth id) have all of them."""
    return ((message_id - message_id % 5) / 5).cast("bigint") % 20


def fixture_channel(message_id: Column) -> Column:
    """Channel display name of a message or image (8 channels, all four types), from its id alone,
    so that every event and every order has one."""
    k = fixture_folder(message_id)
    return (F.when(k % 5 == 0, "CheMed")
            .when(k % 5 == 1, "Lobelia pharmacy and cosmetics")
            .when(k % 5 == 2, "Tikvah | Pharma")
            .when(k % 5 == 3, " Beauty Hub ")
            .otherwise(F.concat(F.lit("src"), k.cast("string"))))


def raw_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``raw.channel_messages`` rows: one per event, and one per document. A document is the text of
    the event with five times its id; a document without that event has no date, an event without
    a document has a short text of its own, a blank one, or none."""
    # a merge join deals the texts out by key: what follows is as parallel as the shuffle, not as the
    # number of splits of a small file
    d = table(spark, sf_dir, "documents").select("doc_id", "text").hint("merge")
    e = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    j = e.join(d, e.event_id == d.doc_id * 5, "full_outer").withColumn("mid", F.coalesce("event_id", F.col("doc_id") * 5))
    mid = F.col("mid")
    error = F.col("event_type") == "error"
    own = (F.when(error & (F.col("user_id") % 2 == 0), F.lit("   "))
           .when(~error, F.concat(F.col("event_type"), F.lit(" by "), F.col("user_id").cast("string"))))
    return j.select(
        mid.alias("message_id"),
        fixture_channel(mid).alias("channel_name"),
        F.col("ts").alias("message_date"),
        F.coalesce(F.col("text"), own).alias("message_text"),
        (~error).alias("has_media"),
        F.when(mid % 2 == 0, F.concat(F.lit("data/raw/images/src"), fixture_folder(mid).cast("string"), F.lit("/"),
                                      mid.cast("string"), F.lit(".jpg")))
         .when(mid % 3 == 0, F.lit("")).alias("image_path"),
        F.floor(F.col("value")).cast("int").alias("views"),
        F.when(F.col("event_type") == "click", F.col("user_id").cast("int")).alias("forwards"),
        F.when(mid % 7 == 0, F.lit(None).cast("boolean")).otherwise(mid % 5 == 0).alias("is_reply"),
        F.when(mid % 5 == 0, mid - 1).alias("reply_to_msg_id"),
        F.col("ts").alias("scraped_at"),
        F.col("ts").alias("loaded_at"),
    )


def raw_messages_dup(spark: SparkSession, sf_dir: str, r: DataFrame | None = None) -> DataFrame:
    """Raw messages with re-scraped copies: a second date for messages without media,
    and a copy under the 'CheMed' channel for forwarded messages of other channels.
    ``r`` is an already built raw message table (default: derived from the test tables)."""
    r = raw_messages(spark, sf_dir) if r is None else r
    shifted = (r.where(~F.col("has_media"))
               .withColumn("message_date", F.col("message_date") + F.expr("interval 1 day")))
    moved = (r.where(F.col("forwards").isNotNull() & (F.col("channel_name") != "CheMed"))
             .withColumn("channel_name", F.lit("CheMed")))
    return r.unionByName(shifted).unionByName(moved)


def insert_scenario(r: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(target, batch) for insert-or-skip over raw messages ``r``: the target holds messages
    before Jan 8; the batch re-delivers everything from Jan 5, and everything from Jan 12 a
    second time. Rows without a date are in all of them. ``batch_seq`` orders the deliveries (first wins)."""
    ts, at = F.col("message_date"), lambda day: F.lit(day).cast("timestamp_ntz")
    target = r.where((ts < at("2024-01-08")) | ts.isNull())
    first = r.where((ts >= at("2024-01-05")) | ts.isNull()).withColumn("batch_seq", F.lit(0))
    again = r.where((ts >= at("2024-01-12")) | ts.isNull()).withColumn("batch_seq", F.lit(1))
    return target, first.unionByName(again)


def boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Box-level detections, one per lineitem; an order is an image."""
    li = table(spark, sf_dir, "lineitem")
    k = F.col("l_partkey") % 8
    cls = (F.when(k == 0, "person").when(k == 1, "bottle").when(k == 2, "cup").when(k == 3, "dog")
           .when(k == 4, "book").when(k == 5, "car").when(k == 6, "potted plant").otherwise("chair"))
    return li.select(
        F.col("l_orderkey").alias("message_id"),
        F.col("l_linenumber").alias("box_id"),
        cls.alias("class_name"),
        (F.col("l_discount") * 9.5).alias("confidence"),
        F.col("l_quantity").alias("bbox_x1"),
        F.col("l_quantity").alias("bbox_y1"),
        (F.col("l_quantity") + 10).alias("bbox_x2"),
        (F.col("l_quantity") + 20).alias("bbox_y2"),
    )


def channel_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All boxes with the channel of their image."""
    return boxes(spark, sf_dir).withColumn("channel_name", fixture_channel(F.col("message_id")))


def raw_image_detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``raw.image_detections`` rows: per-image rollup of all boxes with a few damaged fields."""
    # count per (image, class) first, so an image's group holds one entry per distinct class
    pc = boxes(spark, sf_dir).groupBy("message_id", "class_name").agg(F.count(F.lit(1)).alias("n"), F.max("confidence").alias("mc"))
    r = pc.groupBy("message_id").agg(
        F.sort_array(F.collect_list(F.struct("class_name", F.col("n").cast("int").alias("n")))).alias("_cls"),
        F.sum("n").cast("int").alias("total_detections"),
        F.max("mc").alias("mc"),
        F.max(F.when(F.col("class_name") == "person", 1).otherwise(0)).alias("hp"),
        F.max(F.when(F.col("class_name").isin("bottle", "cup", "book", "potted plant"), 1).otherwise(0)).alias("ho"),
    ).withColumn("detected_classes", X.repeated_list("_cls", "class_name", "n"))
    mid = F.col("message_id")
    cat = (F.when(mid % 11 == 0, " Promotional ").when(mid % 13 == 0, "BANNER")
           .when(mid % 17 == 0, F.lit(None).cast("string"))
           .when((F.col("hp") == 1) & (F.col("ho") == 1), "promotional")
           .when(F.col("ho") == 1, "product_display").when(F.col("hp") == 1, "lifestyle").otherwise("other"))
    day = F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval((mid % 30).cast("int"))
    return r.select(
        mid.alias("message_id"),
        fixture_channel(mid).alias("channel_name"),
        F.when(mid % 4 == 0, F.lit(None).cast("string")).otherwise(F.lit("img")).alias("image_path"),
        "detected_classes",
        F.when(mid % 29 == 0, F.lit(None).cast("int")).otherwise(F.col("total_detections")).alias("total_detections"),
        F.when(mid % 31 == 0, F.lit(None).cast("decimal(5,4)")).otherwise(F.col("mc").cast("decimal(5,4)")).alias("max_confidence"),
        cat.alias("image_category"),
        day.alias("processed_at"),
        day.alias("loaded_at"),
    )


# Channel configuration (FIXTURES §1.6): fixed values of the reference's scraper.
# (config channel, name pattern, pattern order)
CONFIG_CHANNELS = [("lobelia4cosmetics", "lobelia", 1), ("CheMed123", "chemed", 2), ("tikvahpharma", "tikvah", 3)]
DEFAULT_MAX_IMAGES = 1500
# Expected channels and the display-name variants that count as found.
EXPECTED_CHANNELS = [
    ("CheMed123", ["CheMed", "CheMed123"]),
    ("lobelia4cosmetics", ["Lobelia pharmacy and cosmetics", "lobelia4cosmetics", "Lobelia"]),
    ("tikvahpharma", ["tikvahpharma", "Tikvah", "Tikvah Pharma"]),
]


def channel_config(spark: SparkSession, caps: dict[str, tuple[int | None, int | None]] | None = None) -> DataFrame:
    """config(channel, pattern, pattern_order, max_images, max_messages).

    ``caps`` maps a config channel to (max_messages, max_images); absent → (None, 1500).
    """
    caps = caps or {}
    rows = []
    for ch, pat, order in CONFIG_CHANNELS:
        mm, mi = caps.get(ch, (None, None))
        rows.append((ch, pat, order, mi if mi is not None else DEFAULT_MAX_IMAGES, mm))
    return values(spark, rows, "channel string, pattern string, pattern_order int, max_images int, max_messages int")


def values(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A short fixed list as SQL VALUES: a local relation, whose size the optimizer knows."""
    fields = [f.rsplit(" ", 1) for f in schema.split(", ")]
    lit = lambda v: "NULL" if v is None else str(v) if isinstance(v, int) else "'" + v.replace("'", "\\'") + "'"
    table = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    cols = ", ".join(f"CAST({n} AS {t}) AS {n}" for n, t in fields)
    return spark.sql(f"SELECT {cols} FROM VALUES {table} AS t({', '.join(n for n, _ in fields)})")


def expected_channels(spark: SparkSession) -> DataFrame:
    rows = [(ch, v) for ch, variants in EXPECTED_CHANNELS for v in variants]
    return values(spark, rows, "expected_channel string, variant string")


def detection_insert_scenario(r: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(target, batch) for the detection load over raw detections ``r``: processed before
    Jan 8 is stored; the batch re-delivers everything from Jan 5, and from Jan 12 again."""
    ts = F.col("processed_at")
    target = r.where(ts < F.lit("2024-01-08").cast("timestamp_ntz"))
    first = r.where(ts >= F.lit("2024-01-05").cast("timestamp_ntz")).withColumn("batch_seq", F.lit(0))
    again = r.where(ts >= F.lit("2024-01-12").cast("timestamp_ntz")).withColumn("batch_seq", F.lit(1))
    return target, first.unionByName(again)


def lake_strings(r: DataFrame) -> DataFrame:
    """Raw messages as the lake's loosely typed text: every field a string, the message date
    written with a +03:00 offset (same instant), even ids written as integral decimals."""
    mid = F.col("message_id")
    local = F.col("message_date") + F.expr("interval 3 hours")
    return r.select(
        F.when(mid % 2 == 0, F.concat(mid.cast("string"), F.lit(".0"))).otherwise(mid.cast("string")).alias("message_id"),
        "channel_name",
        F.concat(F.date_format(local, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+03:00")).alias("message_date"),
        "message_text",
        F.col("has_media").cast("string").alias("has_media"),
        "image_path",
        F.col("views").cast("string").alias("views"),
        F.col("forwards").cast("string").alias("forwards"),
        F.col("is_reply").cast("string").alias("is_reply"),
        F.col("reply_to_msg_id").cast("string").alias("reply_to_msg_id"),
        F.date_format("scraped_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("scraped_at"),
    )


def api_messages(r: DataFrame) -> DataFrame:
    """Raw messages seen as API message objects (S12 input): a photo when the message has
    media and an image path, another media type when it has media only."""
    media = (F.when(F.col("has_media") & F.coalesce(F.col("image_path") != "", F.lit(False)), "photo")
             .when(F.col("has_media"), "document"))
    return r.select(
        F.col("message_id").alias("id"), "channel_name", F.col("message_date").alias("date"),
        F.col("message_text").alias("text"), media.alias("media_type"), "views", "forwards",
        F.coalesce(F.col("is_reply"), F.lit(False)).alias("is_reply"), "reply_to_msg_id",
    )
