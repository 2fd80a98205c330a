"""Channel rules (J10-J12, P13, W1), enrichment (A1, A15, A16), quality checks (Q1-Q9)."""

import datetime as dt

from pyspark.sql import functions as F

from chanwh.operators import channels as C
from chanwh.operators import enrich as EN
from chanwh.operators import quality as Q
from chanwh.plans import models as M
from chanwh.sources import fixtures as FX
from tests.conftest import SF001, rows

T = dt.datetime


def names(spark, *ns):
    return spark.createDataFrame([(n,) for n in ns], "channel_name string")


def test_resolve_channels(spark):
    got = rows(C.resolve_channels(names(spark, "CheMed123", "Lobelia pharmacy and cosmetics", "UnknownChannel",
                                        "chemed123", "Tikvah-Pharma"), FX.channel_config(spark)),
               "channel_name", "config_channel", "max_images", "max_messages", "matched")
    assert got == [("CheMed123", "CheMed123", 1500, None, True),
                   ("Lobelia pharmacy and cosmetics", "lobelia4cosmetics", 1500, None, True),
                   ("Tikvah-Pharma", "tikvahpharma", 1500, None, True),
                   ("UnknownChannel", "UnknownChannel", 1500, None, False),
                   ("chemed123", "CheMed123", 1500, None, True)]


def test_expected_presence_and_reconcile(spark):
    lake = names(spark, "CheMed", "Lobelia pharmacy and cosmetics", "x")
    table = names(spark, "CheMed")
    got = rows(C.expected_presence(lake, table, FX.expected_channels(spark)))
    assert got == [("CheMed123", True, True), ("lobelia4cosmetics", True, False), ("tikvahpharma", False, False)]
    rec = rows(C.reconcile(names(spark, "a", "a", "b"), names(spark, "a", "c")))
    assert rec == [("a", 2, 1, "ok"), ("b", 1, 0, "missing_in_table"), ("c", 0, 1, "missing_in_lake")]


def test_valid_usernames(spark):
    got = rows(C.valid_usernames(names(spark, "valid_channel", "@valid_channel", "ab", "invalid-channel!")))
    assert got == [("@valid_channel", True), ("ab", False), ("invalid-channel!", False), ("valid_channel", True)]


def _msgs(spark, channel, n, photo_every=1):
    return [(i, channel, T(2024, 1, 1) + dt.timedelta(hours=i), f"p{i}.jpg" if i % photo_every == 0 else None)
            for i in range(1, n + 1)]


def test_quota(spark):
    data = (_msgs(spark, "CheMed", 6) + _msgs(spark, "Lobelia", 5) + _msgs(spark, "Tikvah", 3)
            + _msgs(spark, "Free", 4, photo_every=2))
    m = spark.createDataFrame(data, "message_id long, channel_name string, message_date timestamp_ntz, image_path string")
    caps = {"CheMed123": (4, 2), "lobelia4cosmetics": (0, 5), "tikvahpharma": (10, 3)}
    resolved = C.resolve_channels(C.distinct_names(m), FX.channel_config(spark, caps))
    existing = spark.createDataFrame([("Tikvah", 90), ("Tikvah", 91)], "channel_name string, message_id long")
    q = C.apply_quota(m, resolved, existing)
    got = {}
    for r in q.collect():
        got.setdefault(r.channel_name, []).append((r.message_id, r.image_downloaded))
    # cap 4 newest messages, 2 newest photos
    assert sorted(got["CheMed"]) == [(3, False), (4, False), (5, True), (6, True)]
    assert "Lobelia" not in got                                   # cap 0
    # cap above count; image cap 3 with 2 stored → 1 new image; over-cap photos keep their rows
    assert sorted(got["Tikvah"]) == [(1, False), (2, False), (3, True)]
    # no configuration: all messages, default image cap
    assert sorted(got["Free"]) == [(1, False), (2, True), (3, False), (4, True)]
    limited = C.apply_quota(m, resolved, existing, request_limit=1)
    assert [r.message_id for r in limited.where(F.col("channel_name") == "Free").collect()] == [4]
    assert [r.message_id for r in limited.where(F.col("channel_name") == "CheMed").collect()] == [6]


def test_rollup_boxes(spark):
    boxes = spark.createDataFrame([
        ("A", 1, "person", 0.5), ("A", 1, "Bottle", 0.91234), ("A", 1, "person", 0.7),
        ("A", 2, "dog", 0.3), ("B", 1, "pills", 0.2),
    ], "channel_name string, message_id long, class_name string, confidence double")
    images = spark.createDataFrame([("A", 1), ("A", 2), ("A", 3), ("B", 1)], "channel_name string, message_id long")
    got = rows(EN.rollup_boxes(boxes, images))
    assert got == [("A", 1, "Bottle, person, person", 3, 0.9123, "promotional"),
                   ("A", 2, "dog", 1, 0.3, "other"),
                   ("A", 3, "", 0, 0.0, "other"),
                   ("B", 1, "pills", 1, 0.2, "product_display")]
    r = EN.rollup_boxes(boxes, images)
    assert rows(EN.category_breakdown(r, 1)) == [("other", 2, 50.0), ("product_display", 1, 25.0),
                                                 ("promotional", 1, 25.0)]
    freq = rows(EN.class_frequency(r))
    assert freq == [("Bottle", 1, 4), ("dog", 1, 4), ("person", 2, 4), ("pills", 1, 4)]


def test_quality_checks_on_fixture(spark):
    raw = FX.raw_messages(spark, SF001)
    w = M.warehouse(raw, FX.raw_image_detections(spark, SF001))
    tables = {"stg_channel_messages": w.stg_messages, "stg_image_detections": w.stg_detections,
              "dim_channels": w.dim_channels, "dim_dates": w.dim_dates, "fct_messages": w.fct_messages,
              "fct_image_detections": w.fct_image_detections}
    res = {r.check_id: r for r in Q.run_checks(tables, as_of="2030-01-01").collect()}
    assert len(res) == 60
    assert all(r.passed for r in res.values()), [k for k, r in res.items() if not r.passed]
    assert w.stg_messages.count() > 800
    # break things: a NULL key, an orphan date key, a duplicate id and a future message
    bad_fct = w.fct_messages.unionByName(w.fct_messages.limit(1)).unionByName(
        w.fct_messages.limit(1).withColumn("date_key", F.lit(19000101)).withColumn("message_id", F.lit(None).cast("long")))
    tables["fct_messages"] = bad_fct
    res = {r.check_id: r.failures for r in Q.run_checks(tables, as_of="2024-01-03").collect()}
    assert res["not_null__fct_messages__message_id"] == 1
    assert res["relationships__fct_messages__date_key"] == 1
    assert res["unique_combination__fct_messages__message_id__channel_key"] == 1
    assert res["assert_no_future_messages"] > 0
    row_ids = Q.failing_rows(tables, Q.Check("relationships", "fct_messages", ("date_key",),
                                             to=("dim_dates", "date_key")))
    assert [r.date_key for r in row_ids.collect()] == [19000101]


def test_one_pass_counts_what_the_failing_rows_are(spark):
    """Each check of a damaged warehouse against its own query, and every table scanned once."""
    import contextlib
    import io
    schema = "message_id long, channel_key string, date_key int, message_text string, message_length int, view_count int, forward_count int, has_image boolean"
    fm = spark.createDataFrame([(1, "a", 1, "x", 1, 1, 0, True), (1, "a", 9, "x", 1, 1, 0, True), (None, "a", None, None, 1, 1, 0, None), (None, "a", 8, "x", 1, 1, 0, True),
                                (2, "zz", 1, "x", 1, None, 0, True), (2, "yy", 2, "x", 1, 1, 0, True), (3, None, 2, "x", 1, 1, 0, True), (1, "b", 2, "x", 1, 1, 0, True)], schema)
    dc = spark.createDataFrame([("a", "n", "Pharmaceutical", 5, 1.5), ("a", "n", "odd", -1, None), ("b", "n", "odd", 0, -2.0), (None, None, None, None, 0.0), (None, "m", "odder", 1, 0.0)],
                               "channel_key string, channel_name string, channel_type string, total_posts long, avg_views double")
    dd = spark.createDataFrame([(1,), (2,), (2,), (None,)], "date_key int")
    tables = {"fct_messages": fm, "dim_channels": dc, "dim_dates": dd}
    checks = [c for c in Q.SCHEMA_CHECKS if c.table in tables and all(x in tables[c.table].columns for x in c.columns)]
    assert len({c.kind for c in checks}) == 6
    res = Q.run_checks(tables, checks)
    got = {r.check_id: r.failures for r in res.collect()}
    assert got == {c.check_id: Q.failing_rows(tables, c).count() for c in checks}
    assert got["relationships__fct_messages__channel_key"] == 2 and got["unique__dim_channels__channel_key"] == 1
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        Q.run_checks(tables, checks).explain()
    assert buf.getvalue().count("LocalTableScan") + buf.getvalue().count("Scan ExistingRDD") == 3
    assert {r.failures for r in Q.run_checks({t: df.limit(0) for t, df in tables.items()}, checks).collect()} == {0}


def test_existing_images_feed_the_quota(spark, tmp_path):
    from chanwh.sources import lake as LK
    root = tmp_path / "data" / "raw" / "images"
    for rel in ["CheMed/1.jpg", "CheMed/2.jpg", "Other/7.png"]:
        p = root / rel
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_bytes(b"x")
    m = spark.createDataFrame(_msgs(spark, "CheMed", 5), "message_id long, channel_name string, "
                              "message_date timestamp_ntz, image_path string")
    resolved = C.resolve_channels(C.distinct_names(m), FX.channel_config(spark, {"CheMed123": (None, 3)}))
    stored = LK.parse_image_path(LK.scan_images(spark, str(root)))
    q = C.apply_quota(m, resolved, stored)
    # cap 3 less 2 stored: photo 5 uses the last of it
    assert [r.message_id for r in q.where(F.col("image_downloaded")).collect()] == [5]


def photos(spark, data):
    return spark.createDataFrame(data, "message_id long, channel_name string, message_date timestamp_ntz, image_path string")


def quota(spark, m, caps, stored=(), **more):
    resolved = C.resolve_channels(C.distinct_names(m), FX.channel_config(spark, caps))
    q = C.apply_quota(m, resolved, spark.createDataFrame(list(stored), "channel_name string, message_id long"), **more)
    return sorted((str(r.channel_name), r.message_id, r.image_downloaded) for r in q.collect())


def test_stored_photos_pass_without_using_the_allowance(spark):
    m = photos(spark, [r for r in _msgs(spark, "CheMed", 5) if r[0] >= 3])
    caps = {"CheMed123": (None, 3)}
    assert quota(spark, m, caps, [("CheMed", 5), ("CheMed", 4)]) == [("CheMed", 3, True), ("CheMed", 4, True), ("CheMed", 5, True)]
    # once the allowance is used up, an older photo is refused although it is stored
    m = photos(spark, _msgs(spark, "CheMed", 5))
    assert quota(spark, m, caps, [("CheMed", 5), ("CheMed", 1)]) == [
        ("CheMed", 1, False), ("CheMed", 2, False), ("CheMed", 3, False), ("CheMed", 4, True), ("CheMed", 5, True)]
    assert not any(r[2] for r in quota(spark, m, caps, [("CheMed", i) for i in range(3)]))


def test_equal_keys_of_two_names_respect_the_caps(spark):
    m = photos(spark, [(1, "CheMed", T(2024, 1, 1), "a"), (1, "chemed123", T(2024, 1, 1), "b")])
    assert quota(spark, m, {"CheMed123": (1, 5)}) == [("CheMed", 1, True)]
    assert quota(spark, m, {"CheMed123": (None, 1)}) == [("CheMed", 1, True), ("chemed123", 1, False)]


def test_rows_without_a_channel_have_the_default_cap(spark):
    data = [(i, None, T(2024, 1, 1) + dt.timedelta(minutes=i), "p") for i in range(C.DEFAULT_MAX_IMAGES + 5)]
    got = quota(spark, photos(spark, data), {"CheMed123": (2, 1)})
    assert sum(r[2] for r in got) == C.DEFAULT_MAX_IMAGES and len(got) == len(data)
    assert not any(r[2] for r in got if r[1] < 5)
    assert quota(spark, photos(spark, data[:3]), {}, request_limit=2) == [("None", 1, True), ("None", 2, True)]


def test_two_configured_names_equal_but_for_case(spark):
    config = FX.values(spark, [("Abc", "zzz", 2, 5, None), ("aBC", "yyy", 1, 7, None)], "channel string, pattern string, pattern_order int, max_images int, max_messages int")
    assert rows(C.resolve_channels(names(spark, "abc"), config), "config_channel") == [("aBC",)]


def test_summary_per_configured_channel(spark):
    from chanwh.operators.profile import ingest_summary
    m = photos(spark, [(1, "CheMed", T(2024, 1, 1), "a"), (2, "chemed123", T(2024, 1, 1), "b"), (3, "chemed123", T(2024, 1, 2), ""), (4, "Other", None, None)])
    resolved = C.resolve_channels(C.distinct_names(m), FX.channel_config(spark, {"CheMed123": (None, 1)}))
    assert rows(ingest_summary(m, resolved, as_of="2024-01-05")) == [
        ("CheMed123", 1, 2, 3, 2, 1, 1), ("Other", 1, 1, 1, 0, 1500, 0), (None, 2, 3, 4, 2, 1501, 1)]
