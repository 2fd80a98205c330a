"""Coerce loosely typed records into the raw table contracts.

Bad numbers and timestamps become NULL (counted by the profiles) instead of failing a
whole chunk; absent columns become typed NULLs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chanwh import schemas as S
from chanwh.functions import exprs as X


def _get(df: DataFrame, name: str):
    return F.col(name) if name in df.columns else F.lit(None).cast("string")


def coerce_messages(df: DataFrame) -> DataFrame:
    """S3: any-typed message records → ``raw.channel_messages`` columns (+ loaded_at now).

    Extra columns such as ``_file`` / ``_pos`` (the lake position) are kept at the end.
    """
    g = lambda n: _get(df, n)
    extra = [c for c in df.columns if c.startswith("_")]
    return df.select(
        X.parse_bigint(g("message_id")).alias("message_id"),
        g("channel_name").cast("string").alias("channel_name"),
        X.parse_timestamp(g("message_date")).alias("message_date"),
        g("message_text").cast("string").alias("message_text"),
        X.parse_bool(g("has_media")).alias("has_media"),
        g("image_path").cast("string").alias("image_path"),
        X.parse_int(g("views")).alias("views"),
        X.parse_int(g("forwards")).alias("forwards"),
        X.parse_bool(g("is_reply")).alias("is_reply"),
        X.parse_bigint(g("reply_to_msg_id")).alias("reply_to_msg_id"),
        X.parse_timestamp(g("scraped_at")).alias("scraped_at"),
        F.current_timestamp().cast("timestamp_ntz").alias("loaded_at"),
        *extra,
    )


def coerce_detections(df: DataFrame) -> DataFrame:
    """Detection CSV rows → ``raw.image_detections`` columns; total NULL → 0."""
    g = lambda n: _get(df, n)
    extra = [c for c in df.columns if c.startswith("_")]
    conf = F.trim(g("max_confidence").cast("string")).try_cast("double")
    return df.select(
        X.parse_bigint(g("message_id")).alias("message_id"),
        g("channel_name").cast("string").alias("channel_name"),
        g("image_path").cast("string").alias("image_path"),
        g("detected_classes").cast("string").alias("detected_classes"),
        F.coalesce(X.parse_int(g("total_detections")), F.lit(0)).alias("total_detections"),
        conf.try_cast(S.RAW_DETECTIONS["max_confidence"].dataType).alias("max_confidence"),
        g("image_category").cast("string").alias("image_category"),
        X.parse_timestamp(g("processed_at")).alias("processed_at"),
        F.current_timestamp().cast("timestamp_ntz").alias("loaded_at"),
        *extra,
    )
