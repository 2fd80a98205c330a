"""Image enrichment: box → image rollup (A1) with its category (P7), breakdowns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chanwh.functions import exprs as X

IMAGE_KEYS = ["channel_name", "message_id"]


def rollup_boxes(boxes: DataFrame, images: DataFrame | None = None) -> DataFrame:
    """A1: one row per image from box-level detections.

    boxes(channel_name, message_id, class_name, confidence, ...) →
    (channel_name, message_id, detected_classes, total_detections, max_confidence, image_category)

    ``detected_classes`` is every box's class, sorted, joined by ', ' (repeats kept). Boxes are
    first counted per (image, class) — partial aggregation absorbs any hot image — so the
    per-image array holds one entry per distinct class; only the text grows with the boxes.

    ``images`` (channel_name, message_id[, image_path]) adds images without boxes (total 0,
    confidence 0.0, category 'other'), as the reference does for an empty detection list.
    """
    per_class = boxes.groupBy(*IMAGE_KEYS, "class_name").agg(
        F.count(F.lit(1)).alias("n"), F.max("confidence").alias("mc"))
    per_image = per_class.groupBy(*IMAGE_KEYS).agg(
        F.sum("n").cast("int").alias("total_detections"),
        F.max("mc").alias("_mc"),
        F.sort_array(F.collect_list(F.struct("class_name", F.col("n").cast("int").alias("n")))).alias("_cls"),
        F.collect_set(F.lower("class_name")).alias("_set"),
    )
    out = per_image.select(
        *IMAGE_KEYS,
        X.repeated_list("_cls", "class_name", "n").alias("detected_classes"),
        "total_detections",
        F.round("_mc", 4).alias("max_confidence"),
        X.classify_classes("_set").alias("image_category"),
    )
    if images is None:
        return out
    return images.join(out, IMAGE_KEYS, "left").select(
        *images.columns,
        F.coalesce("detected_classes", F.lit("")).alias("detected_classes"),
        F.coalesce("total_detections", F.lit(0)).alias("total_detections"),
        F.coalesce("max_confidence", F.lit(0.0)).alias("max_confidence"),
        F.coalesce("image_category", F.lit("other")).alias("image_category"),
    )


def category_breakdown(df: DataFrame, digits: int = 2) -> DataFrame:
    """A14 (digits=2, loaded table) / A15 (digits=1, a detection run): count and share per category.

    The denominator is a scalar subquery over the grouped counts (no join, no second scan).
    """
    g = df.groupBy("image_category").agg(F.count(F.lit(1)).alias("count"))
    # the denominator sums the grouped counts: same aggregate, so one scan of the input
    total = g.agg(F.sum("count")).scalar()
    g = g.select("image_category", "count", total.alias("_total"))
    return g.select("image_category", "count", X.pct("count", "_total", digits).alias("percentage")) \
            .orderBy(F.desc("count"), F.asc_nulls_first("image_category"))


def class_frequency(df: DataFrame, top: int = 10) -> DataFrame:
    """Most frequent object classes over comma-separated ``detected_classes``, with the
    number of distinct classes seen (as a column of every row)."""
    nonempty = df.where(F.col("detected_classes").isNotNull() & (F.col("detected_classes") != ""))
    parts = nonempty.select(F.explode(F.split("detected_classes", ",", -1)).alias("_c"))
    cls = parts.select(F.trim("_c").alias("class_name"))
    counts = cls.groupBy("class_name").agg(F.count(F.lit(1)).alias("count"))
    distinct = counts.agg(F.count(F.lit(1))).scalar()
    return counts.orderBy(F.desc("count"), F.asc("class_name")).limit(top) \
                 .select("class_name", "count", distinct.alias("unique_classes"))
