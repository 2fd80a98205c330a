"""Plan-shape tests: the scale and skew guarantees the README claims, read from .explain()."""

import contextlib
import datetime as dt
import io

from pyspark.sql import functions as F

from chanwh.operators import channels as C
from chanwh.operators import load as L
from chanwh.plans import models as M
from chanwh.plans import reports as R
from chanwh.sources import fixtures as FX
from tests.test_models import raw


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def msgs(spark, n=40):
    return spark.createDataFrame(
        [(i, "hot" if i % 3 else f"c{i % 5}", dt.datetime(2024, 1, 1) + dt.timedelta(minutes=i), f"p{i}.jpg")
         for i in range(n)],
        "message_id long, channel_name string, message_date timestamp_ntz, image_path string")


def test_quota_finds_cutoffs_by_counting(spark):
    """No window holds the rows of a channel or of one of its days: what is ordered are counted bins, and the messages
    are joined with at most one cut-off for each limit."""
    m = msgs(spark)
    resolved = C.resolve_channels(C.distinct_names(m), FX.channel_config(spark, {"CheMed123": (5, 2)}))
    p = plan(C.apply_quota(m, resolved, m.select("channel_name", "message_id").limit(3)))
    assert "row_number" not in p and "rank(" not in p
    windows = [line for line in p.splitlines() if "Window [" in line]
    assert len(windows) == 3 and all("sum(_w" in line for line in windows)


def test_cutoffs_equal_ranking_all_rows(spark):
    """Against plain ranking, with ties in dates, ids and names, missing dates, repeated rows, and a limit at each place."""
    import random
    rng = random.Random(4)
    data = []
    for _ in range(400):
        d = rng.choice([None, dt.datetime(2024, 1, rng.randrange(1, 5), 0, 0, rng.randrange(3))])
        data.append((rng.randrange(60) << rng.choice([0, 19, 21]), rng.choice(["hot", "Hot", "b", None]), d, rng.choice(["p.jpg", "", None])))
    m = spark.createDataFrame(data, "message_id long, channel_name string, message_date timestamp_ntz, image_path string")
    stored = {(r[1], r[0]) for r in rng.sample(data, 60) if r[1]}
    held = spark.createDataFrame(sorted(stored), "channel_name string, message_id long")

    def order(r):
        return (r[2] is None, -(r[2] - dt.datetime(2024, 1, 1)).total_seconds() if r[2] else 0, -r[0], r[1] is not None, r[1] or "")

    for cap, images in [(1, 70), (17, 61), (90, 100), (250, 90), (None, 80), (5000, 5000), (0, 9)]:
        config = FX.values(spark, [("hot", "zzz", 1, images, cap)], "channel string, pattern string, pattern_order int, max_images int, max_messages int")
        got = C.apply_quota(m, C.resolve_channels(C.distinct_names(m), config), held)
        want = []
        for names in (("hot", "Hot"), ("b",), (None,)):
            own = sorted((r for r in data if r[1] in names), key=order)
            room = (images if "hot" in names else 1500) - sum(n in names for n, _ in stored)
            limit = cap if "hot" in names else None
            # rows that are equal in date, id and name share the verdict of the first of them
            ranks = {}
            used = 0
            for k, r in enumerate(own):
                ranks.setdefault(r[:3], (k, used))
                used += bool(r[3]) and (r[1], r[0]) not in stored
            for r in own:
                k, before = ranks[r[:3]]
                if limit is None or k < limit:
                    want.append((r[0], str(r[1]), str(r[2]), bool(r[3]), bool(r[3]) and room > 0 and before < room))
        assert sorted((r.message_id, str(r.channel_name), str(r.message_date), r.has_photo, r.image_downloaded) for r in got.collect()) == sorted(want), (cap, images)


def test_first_wins_dedupe_aggregates_map_side(spark):
    b = msgs(spark).withColumn("seq", F.lit(0))
    d = L.dedupe_first(b, ["message_id", "channel_name", "message_date"], ["seq"])
    assert "partial_min_by" in plan(d)


def test_top_terms_plan(spark):
    r = raw(spark, [dict(message_id=i, channel_name="A", message_date=dt.datetime(2024, 1, 1),
                         message_text="alpha beta gamma alpha") for i in range(5)])
    w = M.warehouse(r)
    p = plan(R.top_terms(w.fct_messages, 10, 4))
    assert "TakeOrderedAndProject" in p              # per-partition top-k, no global sort
    assert "partial_count" in p                      # map-side combine of term counts
    assert "rangepartitioning" not in p
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_fact_joins_broadcast_small_dimensions_at_run_time(spark):
    r = raw(spark, [dict(message_id=i, channel_name=f"c{i % 3}", message_date=dt.datetime(2024, 1, 1 + i % 4),
                         message_text="x") for i in range(12)])
    w = M.warehouse(r)
    df = M.fct_messages(w.stg_messages, w.dim_channels, w.dim_dates)
    assert sorted(map(str, df.collect())) == sorted(map(str, w.fct_messages.select(df.columns).collect()))
    final = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert final.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in final


KEYS = ["message_id", "channel_name", "message_date"]


def test_insert_target_is_partition_pruned(spark, tmp_path):
    """A day-partitioned target is read only for the batch's days, also when one row is late."""
    from chanwh.sources.tables import partition_values
    target_path = str(tmp_path / "raw")
    old = msgs(spark).select(*KEYS).unionByName(msgs(spark).select(*KEYS).withColumn("message_date", F.expr("message_date + interval 9 days")))
    L.with_day_partition(old).write.partitionBy(L.DAY_PARTITION).parquet(target_path)
    target = spark.read.parquet(target_path)
    late = msgs(spark, 1).select(*KEYS).withColumn("message_date", F.lit("2019-05-01").cast("timestamp_ntz"))
    batch = msgs(spark, 5).select(*KEYS).unionByName(late).withColumn("seq", F.lit(0))
    days = partition_values(batch, F.to_date("message_date"))
    assert sorted(map(str, days)) == ["2019-05-01", "2024-01-01"]
    p = plan(L.insert_or_skip(target, batch, KEYS, ["seq"], prune={"dt": days}))
    filters = p.split("PartitionFilters:")[1].split("PushedFilters")[0]
    assert "dt#" in filters and "2019-05-01" in filters and "2024-01-01" in filters and ">=" not in filters


def test_insert_evaluates_the_batch_once(spark, tmp_path):
    path = str(tmp_path / "b")
    msgs(spark).select(*KEYS).withColumn("seq", F.lit(0)).write.parquet(path)
    target = spark.createDataFrame([], "message_id long, channel_name string, message_date timestamp_ntz")
    assert plan(L.insert_or_skip(target, spark.read.parquet(path), KEYS, ["seq"])).count("FileScan parquet") == 1


SF001 = "/root/testdata/sf0.001"


def test_queries_read_pruned_parquet(spark):
    from chanwh import catalog
    for name in ("top_terms", "valid_usernames", "dim_dates", "visual_by_channel", "quality_report", "dup_raw", "box_rollup"):
        p = plan(catalog.QUERIES[name](spark, SF001))
        assert "FileScan parquet" in p and "ExistingRDD" not in p and "CartesianProduct" not in p, name
    p = plan(catalog.QUERIES["valid_usernames"](spark, SF001))
    assert "text" not in p                                     # no message body is read for the names
    p = plan(catalog.QUERIES["detection_profile"](spark, SF001))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint>" in p or "l_quantity" not in p
    p = plan(catalog.QUERIES["search_count"](spark, SF001))
    assert "PushedFilters: [" in p


def test_whole_tables_reach_the_raw_layer(spark):
    from chanwh.sources import fixtures as FX
    table = lambda n: FX.table(spark, SF001, n)
    raw_m, docs = FX.raw_messages(spark, SF001), table("documents")
    assert raw_m.where(F.col("message_date").isNotNull()).count() == table("events").count()
    have = {r.message_text for r in raw_m.select("message_text").collect()}
    assert {r.text for r in docs.select("text").collect()} <= have
    det = FX.raw_image_detections(spark, SF001)
    assert FX.channel_boxes(spark, SF001).count() == table("lineitem").count()
    assert det.count() == table("lineitem").select("l_orderkey").distinct().count()
    boxes = det.select(F.size(F.split("detected_classes", ", ")).alias("n")).agg(F.sum("n")).first()[0]
    assert boxes == table("lineitem").count()


def test_cross_channel_lists_are_built_after_the_limit(spark):
    from chanwh.operators import profile as P
    p = plan(P.dup_cross_channel(msgs(spark)))
    lists, top = p.index("collect_set"), p.index("TakeOrderedAndProject")
    assert p.rindex("TakeOrderedAndProject") > lists >= 0 and top >= 0


def test_terms_are_exploded_once_for_rows_and_totals(spark):
    from chanwh import catalog
    df = catalog.QUERIES["top_terms_envelope"](spark, SF001)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "ReusedExchange" in final or "ReusedSubquery" in final


def test_names_meet_the_configuration_by_keys(spark):
    """No nested loop, and the same as comparing each name with each row of the configuration."""
    import itertools
    import random
    import re
    rng = random.Random(8)
    names = [*{"".join(rng.choice("aAbB é-_日") for _ in range(rng.randrange(1, 7))) for _ in range(150)}]
    config = [(f"{c}{i}" if i % 3 else c, p, i, 100 + i, None) for i, (c, p) in enumerate(zip(["ab", "A b", "B", "日", "x", "aab"], ["ab", "aab", "é", None, "日a", "b"]))]
    df = spark.createDataFrame([(n,) for n in names], "channel_name string")
    cf = FX.values(spark, config, "channel string, pattern string, pattern_order int, max_images int, max_messages int")
    got = C.resolve_channels(df, cf)
    assert "NestedLoop" not in plan(got) and "Cartesian" not in plan(got)

    def tier(n, c, p, order):
        if n == c:
            return 1
        return 2 if n.lower() == c.lower() else 10 + order if p is not None and p in re.sub("[ _-]", "", n.lower()) else None

    want = []
    for n in names:
        ranks = [(t, order, c, m) for c, p, order, m, _ in config if (t := tier(n, c, p, order))]
        best = min(ranks) if ranks else None
        want.append((n, best[2] if best else n, best[3] if best else 1500))
    assert sorted(map(tuple, got.select("channel_name", "config_channel", "max_images").collect())) == sorted(want)

    expected = [(f"e{i}", v) for i, v in enumerate(["AB", "日", "abAB é", "x", "b-"])] + [("e0", "_é"), ("e3", "")]
    ex = FX.values(spark, expected, "expected_channel string, variant string")
    half = df.where(F.length("channel_name") > 3)
    found = C.expected_presence(half, df, ex)
    assert "NestedLoop" not in plan(found) and "Cartesian" not in plan(found)
    hit = lambda e, some: any(v.lower() in n.lower() or n.lower() in v.lower() for (x, v), n in itertools.product(expected, some) if x == e)
    assert sorted(map(tuple, found.collect())) == sorted((e, hit(e, [n for n in names if len(n) > 3]), hit(e, names)) for e in {e for e, _ in expected})
