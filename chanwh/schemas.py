"""Raw table contracts as StructType constants, and their unique keys."""

from __future__ import annotations

from pyspark.sql import types as T

RAW_MESSAGES = T.StructType([
    T.StructField("message_id", T.LongType()),
    T.StructField("channel_name", T.StringType()),
    T.StructField("message_date", T.TimestampNTZType()),
    T.StructField("message_text", T.StringType()),
    T.StructField("has_media", T.BooleanType()),
    T.StructField("image_path", T.StringType()),
    T.StructField("views", T.IntegerType()),
    T.StructField("forwards", T.IntegerType()),
    T.StructField("is_reply", T.BooleanType()),
    T.StructField("reply_to_msg_id", T.LongType()),
    T.StructField("scraped_at", T.TimestampNTZType()),
    T.StructField("loaded_at", T.TimestampNTZType()),
])
RAW_MESSAGES_KEY = ["message_id", "channel_name", "message_date"]

RAW_DETECTIONS = T.StructType([
    T.StructField("message_id", T.LongType(), nullable=False),
    T.StructField("channel_name", T.StringType(), nullable=False),
    T.StructField("image_path", T.StringType()),
    T.StructField("detected_classes", T.StringType()),
    T.StructField("total_detections", T.IntegerType()),
    T.StructField("max_confidence", T.DecimalType(5, 4)),
    T.StructField("image_category", T.StringType()),
    T.StructField("processed_at", T.TimestampNTZType()),
    T.StructField("loaded_at", T.TimestampNTZType()),
])
RAW_DETECTIONS_KEY = ["message_id", "channel_name"]

# Field order of the detection CSV.
DETECTION_CSV_FIELDS = ["message_id", "channel_name", "image_path", "detected_classes", "total_detections",
                        "max_confidence", "image_category", "processed_at"]

# Message-lake record fields, in file order.
LAKE_FIELDS = ["message_id", "channel_name", "message_date", "message_text", "has_media", "image_path",
               "views", "forwards", "is_reply", "reply_to_msg_id", "scraped_at"]

BOXES = T.StructType([
    T.StructField("channel_name", T.StringType()),
    T.StructField("message_id", T.LongType()),
    T.StructField("image_path", T.StringType()),
    T.StructField("class_name", T.StringType()),
    T.StructField("confidence", T.DoubleType()),
    T.StructField("bbox_x1", T.DoubleType()),
    T.StructField("bbox_y1", T.DoubleType()),
    T.StructField("bbox_x2", T.DoubleType()),
    T.StructField("bbox_y2", T.DoubleType()),
])
