"""The end-to-end batch pipeline — ingest → rollup → load → models → checks.

Sequential (each step reads what the previous one wrote); returns the rows each load added. A load is a commit
under the run's name, so a run that died is resumed by running it again: loads that are committed are
not repeated, marts are rebuilt as a whole.
Scheduling is left to the cluster's scheduler.
"""

from __future__ import annotations

import os
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chanwh import schemas as S
from chanwh.operators.enrich import rollup_boxes
from chanwh.operators.load import (BUCKET_PARTITION, KEY_BUCKETS, detection_table, insert_or_skip, message_table, with_key_bucket,
                                   write_detections_csv)
from chanwh.operators.quality import run_checks
from chanwh.plans.models import build_warehouse
from chanwh.sources.coerce import coerce_messages
from chanwh.sources.lake import parse_image_path, scan_images, scan_message_lake
from chanwh.sources.tables import partition_values, staged
from chanwh.streaming.ingest import append_messages


@dataclass
class PipelineConfig:
    lake: str                      # message lake root (JSON files)
    out: str                       # warehouse root: raw/, marts/, detections_csv/
    boxes: DataFrame | None = None  # box-level detections (the inference output contract)
    images: DataFrame | None = None  # known images (channel_name, message_id[, image_path])
    image_lake: str | None = None   # image lake root; scanned (S9/S10) when ``images`` is not given
    skip_ingest: bool = False
    run_id: str | None = None      # names this run's loads: a run that died is resumed under the same name
    as_of: str | None = None


def append_detections(spark: SparkSession, detections: DataFrame, target: str, name: str | None = None) -> int:
    """Insert-or-skip into the raw detection table as one commit: only the buckets that the batch has are
    read, and nothing of the table is counted. Returns the rows added."""
    batch, table = with_key_bucket(detections), detection_table(spark, target)
    new = insert_or_skip(table.read(), batch, S.RAW_DETECTIONS_KEY, ["_file", "_pos"], reject_null_keys=True,
                         prune={BUCKET_PARTITION: partition_values(batch, BUCKET_PARTITION, KEY_BUCKETS)})
    return table.append(new, name)


def run_pipeline(spark: SparkSession, cfg: PipelineConfig) -> dict:
    counts: dict = {}
    raw_m_path = os.path.join(cfg.out, "raw", "channel_messages")
    raw_d_path = os.path.join(cfg.out, "raw", "image_detections")

    run = cfg.run_id or uuid.uuid4().hex
    raw_m, raw_d = message_table(spark, raw_m_path), detection_table(spark, raw_d_path)
    if not cfg.skip_ingest and not raw_m.has(run):
        append_messages(spark, coerce_messages(scan_message_lake(spark, cfg.lake)), raw_m_path, run)
    if not cfg.skip_ingest:
        counts["messages_loaded"] = raw_m.commits().get(run, 0)

    images = cfg.images
    if images is None and cfg.image_lake:
        images = parse_image_path(scan_images(spark, cfg.image_lake)).select(
            "channel_name", "message_id", F.col("path").alias("image_path"))
    if cfg.boxes is not None and not raw_d.has(run):
        now = F.current_timestamp().cast("timestamp_ntz")
        rolled = rollup_boxes(cfg.boxes, images)
        if "image_path" not in rolled.columns:
            rolled = rolled.withColumn("image_path", F.lit(None).cast("string"))
        stored = rolled.withColumns({"processed_at": now, "loaded_at": now, "max_confidence": F.col("max_confidence").cast("decimal(5,4)")})
        # one evaluation of the boxes, read by the export and the load
        with staged(stored, raw_d_path) as rows:
            write_detections_csv(rows, os.path.join(cfg.out, "detections_csv"))
            det = rows.select(*[f.name for f in S.RAW_DETECTIONS.fields], F.lit("").alias("_file"), F.lit(0).alias("_pos"))
            append_detections(spark, det, raw_d_path, run)
    if cfg.boxes is not None:
        counts["detections_loaded"] = raw_d.commits().get(run, 0)

    counts.update(build_warehouse(spark, raw_m.read(), raw_d.read(), cfg.out))
    tables = {n: spark.table(n) for n in ("stg_channel_messages", "stg_image_detections", "dim_channels",
                                          "dim_dates", "fct_messages", "fct_image_detections")}
    checks = run_checks(tables, as_of=cfg.as_of)
    failed = checks.where(~F.col("passed")).select("check_id", "failures").collect()   # ≤ 60 rows
    counts["checks_failed"] = {r["check_id"]: r["failures"] for r in failed}
    return counts
