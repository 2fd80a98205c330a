"""Property tests: exact rounding, gap-free date dimension, category totals,
idempotent insert-or-skip."""

import datetime as dt
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from chanwh.functions import exprs as X
from chanwh.operators import load as L
from chanwh.plans import models as M
from chanwh.plans import reports as R
from tests.test_models import raw


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 10**12), st.integers(1, 10**12)), min_size=1, max_size=40))
def test_pct_is_exact_half_up(spark, pairs):
    df = spark.createDataFrame(pairs, "a long, b long")
    got = [r[0] for r in df.select(X.pct("a", "b")).collect()]
    want = [float((Decimal(a) * 100 / Decimal(b)).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)) for a, b in pairs]
    assert got == want


@settings(max_examples=4, deadline=None)
@given(st.lists(st.dates(dt.date(2020, 1, 1), dt.date(2026, 12, 31)), min_size=1, max_size=15))
def test_dim_dates_has_no_gaps(spark, days):
    r = raw(spark, [dict(message_id=i, channel_name="A", message_date=dt.datetime.combine(d, dt.time(12)),
                         message_text="x") for i, d in enumerate(days)])
    got = [x.full_date for x in M.dim_dates(M.stg_messages(r)).orderBy("full_date").collect()]
    assert got[0] == min(days) and got[-1] == max(days)
    assert len(got) == (max(days) - min(days)).days + 1 == len(set(got))


@settings(max_examples=4, deadline=None)
@given(st.lists(st.sampled_from(["promotional", "product_display", "lifestyle", "other", "BANNER", None]),
                min_size=1, max_size=30))
def test_visual_counts_sum_to_total(spark, cats):
    msgs = raw(spark, [dict(message_id=i, channel_name=f"c{i % 3}", message_date=dt.datetime(2024, 1, 1),
                            message_text="x") for i in range(len(cats))])
    det = spark.createDataFrame([(i, f"c{i % 3}", None, None, None, None, c, None, None) for i, c in enumerate(cats)],
                                "message_id long, channel_name string, image_path string, detected_classes string, "
                                "total_detections int, max_confidence decimal(5,4), image_category string, "
                                "processed_at timestamp_ntz, loaded_at timestamp_ntz")
    w = M.warehouse(msgs, det)
    per = R.visual_by_channel(w.fct_image_detections, w.dim_channels)
    bad = per.where(F.col("promotional_count") + F.col("product_display_count") + F.col("lifestyle_count")
                    + F.col("other_count") != F.col("total_images")).count()
    assert bad == 0
    o = R.visual_overall(w.fct_image_detections, w.dim_channels).first()
    assert o.total_images == len(cats)


@settings(max_examples=4, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 6), st.sampled_from(["A", "B"]), st.integers(1, 3)), max_size=25))
def test_insert_or_skip_idempotent_and_unique(spark, recs):
    schema = "message_id long, channel_name string, message_date timestamp_ntz, seq int"
    batch = spark.createDataFrame([(i, c, dt.datetime(2024, 1, d), n) for n, (i, c, d) in enumerate(recs)], schema)
    target = spark.createDataFrame([], schema).drop("seq")
    keys = ["message_id", "channel_name", "message_date"]
    first = L.insert_or_skip(target, batch, keys, ["seq"])
    assert first.count() == len(set(recs))
    assert L.insert_or_skip(first, batch, keys, ["seq"]).count() == 0
