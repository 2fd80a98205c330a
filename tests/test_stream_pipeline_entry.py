"""Incremental ingest (S14), end-to-end pipeline (N5), the driver contract against DuckDB."""

import json
import os

import duckdb
import pytest

from chanwh.operators.load import detection_table, message_table
from chanwh.plans.pipeline import PipelineConfig, run_pipeline
from chanwh.streaming.ingest import ingest_increment
from tests.conftest import SF001


def drop(root, day, channel, recs):
    d = os.path.join(root, day)
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, f"{channel}.json"), "w", encoding="utf-8") as f:
        json.dump(recs, f, indent=2)


def rec(i, ch="CheMed", day="2024-01-01", text="aspirin tablets"):
    return {"message_id": i, "channel_name": ch, "message_date": f"{day}T10:00:0{i % 10}+00:00",
            "message_text": text, "has_media": i % 2 == 0, "image_path": None, "views": i, "forwards": 0,
            "is_reply": False, "reply_to_msg_id": None, "scraped_at": f"{day}T12:00:00"}


def table_rows(spark, path):
    return sorted((r.message_id, r.channel_name, str(r.message_date))
                  for r in message_table(spark, path).read().collect())


def test_incremental_ingest_matches_one_batch(spark, tmp_path):
    lake, lake_all = str(tmp_path / "lake"), str(tmp_path / "lake_all")
    tgt, tgt_all = str(tmp_path / "t"), str(tmp_path / "t_all")
    first = [rec(i) for i in range(1, 6)]
    second = [rec(i) for i in range(4, 9)]                       # overlaps ids 4, 5
    drop(lake, "2024-01-01", "CheMed", first)
    ingest_increment(spark, lake, tgt, checkpoint=str(tmp_path / "ck"))
    drop(lake, "2024-01-02", "CheMed", second)
    with open(os.path.join(lake, "2024-01-02", "bad.json"), "w") as f:
        f.write("{not json")
    ingest_increment(spark, lake, tgt, checkpoint=str(tmp_path / "ck"))
    ingest_increment(spark, lake, tgt, checkpoint=str(tmp_path / "ck"))   # idle re-run
    drop(lake_all, "2024-01-01", "CheMed", first)
    drop(lake_all, "2024-01-02", "CheMed", second)
    ingest_increment(spark, lake_all, tgt_all, checkpoint=str(tmp_path / "ck_all"))
    got = table_rows(spark, tgt)
    assert got == table_rows(spark, tgt_all)
    assert [g[0] for g in got] == list(range(1, 9))


def test_pipeline_end_to_end(spark, tmp_path):
    lake = str(tmp_path / "lake")
    drop(lake, "2024-01-01", "CheMed", [rec(i) for i in range(1, 6)])
    drop(lake, "2024-01-02", "Tikvah", [rec(i, "Tikvah | Pharma", "2024-01-02", "bottle shop") for i in range(1, 4)])
    boxes = spark.createDataFrame([("CheMed", 2, "person", 0.9), ("CheMed", 2, "bottle", 0.8),
                                   ("Tikvah | Pharma", 1, "dog", 0.4)],
                                  "channel_name string, message_id long, class_name string, confidence double")
    out = str(tmp_path / "wh")
    counts = run_pipeline(spark, PipelineConfig(lake=lake, out=out, boxes=boxes, as_of="2030-01-01"))
    assert counts["messages_loaded"] == 8 and counts["detections_loaded"] == 2
    assert counts["fct_messages"] == 8 and counts["fct_image_detections"] == 2
    assert counts["dim_dates"] == 2 and counts["checks_failed"] == {}
    again = run_pipeline(spark, PipelineConfig(lake=lake, out=out, boxes=boxes, as_of="2030-01-01"))
    assert again["messages_loaded"] == 0 and again["detections_loaded"] == 0     # insert-or-skip
    assert again["fct_messages"] == 8 and again["fct_image_detections"] == 2


def test_a_run_that_died_is_resumed_by_its_name(spark, tmp_path, monkeypatch):
    """Its loads were committed and are not repeated, although a row without a date equals no stored one."""
    from chanwh.plans import pipeline
    lake, out = str(tmp_path / "lake"), str(tmp_path / "wh")
    drop(lake, "2024-01-01", "CheMed", [*[rec(i) for i in range(1, 4)], {**rec(9), "message_date": None}])
    boxes = spark.createDataFrame([("CheMed", 2, "person", 0.9)], "channel_name string, message_id long, class_name string, confidence double")
    cfg = PipelineConfig(lake=lake, out=out, boxes=boxes, as_of="2030-01-01", run_id="daily-2024-01-01")
    real = pipeline.build_warehouse

    def die(*a):
        raise RuntimeError("lost the driver")

    monkeypatch.setattr(pipeline, "build_warehouse", die)
    with pytest.raises(RuntimeError):
        run_pipeline(spark, cfg)
    monkeypatch.setattr(pipeline, "build_warehouse", real)
    monkeypatch.setattr(pipeline, "scan_message_lake", die)                # not even read again
    counts = run_pipeline(spark, cfg)
    assert counts["messages_loaded"] == 4 and counts["detections_loaded"] == 1 and counts["fct_messages"] == 3
    assert message_table(spark, os.path.join(out, "raw", "channel_messages")).commits() == {"daily-2024-01-01": 4}


def test_responses_are_stamped(spark):
    import datetime as dt
    from chanwh.plans import reports as R
    at = dt.datetime(2024, 1, 2, 3, 4, 5)
    assert R.stamped(spark.range(1), at).first().generated_at == at
    assert abs(R.stamped(spark.range(1)).first().generated_at - dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)) < dt.timedelta(minutes=5)


def test_pipeline_on_uris_twice_without_detections(spark, tmp_path):
    from chanwh.plans.models import layer_listing, open_warehouse
    lake, out = str(tmp_path / "lake"), "file://" + str(tmp_path / "wh")
    drop(lake, "2024-01-01", "CheMed", [rec(i) for i in range(1, 6)])
    for loaded in (5, 0):
        counts = run_pipeline(spark, PipelineConfig(lake="file://" + lake, out=out, as_of="2030-01-01"))
        assert counts["messages_loaded"] == loaded and counts["fct_messages"] == 5 and counts["fct_image_detections"] == 0
    w = open_warehouse(spark, out)
    assert w.fct_messages.count() == 5 and w.fct_image_detections.count() == 0
    boxes = spark.createDataFrame([("CheMed", 2, "person", 0.9)], "channel_name string, message_id long, class_name string, confidence double")
    assert run_pipeline(spark, PipelineConfig(lake=lake, out=out, boxes=boxes, as_of="2030-01-01"))["fct_image_detections"] == 1
    assert open_warehouse(spark, out).fct_image_detections.count() == 1
    listing = {(r.layer, r.table_name): (r.status, r.row_count) for r in layer_listing(spark, out).collect()}
    assert listing["marts", "fct_messages"] == ("present", 5) and listing["raw", "image_detections"] == ("present", 1)
    build = str(tmp_path / "other")
    from chanwh.plans.models import build_warehouse
    build_warehouse(spark, message_table(spark, os.path.join(out, "raw", "channel_messages")).read(), None, build)
    listing = {(r.layer, r.table_name): (r.status, r.row_count) for r in layer_listing(spark, build).collect()}
    assert listing["marts", "fct_image_detections"] == ("missing", None) and listing["raw", "channel_messages"] == ("missing", None)


def test_pipeline_on_an_empty_lake(spark, tmp_path):
    os.makedirs(tmp_path / "lake")
    counts = run_pipeline(spark, PipelineConfig(lake=str(tmp_path / "lake"), out=str(tmp_path / "wh"), as_of="2030-01-01"))
    assert counts["messages_loaded"] == 0 and counts["fct_messages"] == 0 and counts["dim_dates"] == 0


def test_ingest_progress_outlives_the_session(spark, tmp_path):
    """Two sessions, a URI target, no progress folder given: nothing is read or added twice, also no
    row without a date."""
    lake, tgt = str(tmp_path / "lake"), "file://" + str(tmp_path / "t")
    nodate = {**rec(7), "message_date": None}
    drop(lake, "2024-01-01", "CheMed", [rec(1), nodate])
    ingest_increment(spark, lake, tgt)
    other = spark.newSession()
    ingest_increment(other, lake, tgt)
    assert [r[0] for r in table_rows(other, tgt)] == [1, 7]
    drop(lake, "2024-01-02", "CheMed", [rec(1), rec(2)])
    ingest_increment(other, lake, tgt)
    assert [r[0] for r in table_rows(spark, tgt)] == [1, 2, 7]
    assert os.path.isdir(str(tmp_path / "t") + "_progress")


def test_a_batch_that_runs_again_adds_nothing(spark, tmp_path):
    import shutil
    lake, tgt = str(tmp_path / "lake"), str(tmp_path / "t")
    drop(lake, "2024-01-01", "CheMed", [{**rec(7), "message_date": None}])
    ingest_increment(spark, lake, tgt)
    for name in ("0", ".0.crc"):                                            # as if Spark died before its commit
        shutil.move(f"{tgt}_progress/commits/{name}", str(tmp_path / f"lost{name}"))
    ingest_increment(spark, lake, tgt)
    assert len(table_rows(spark, tgt)) == 1


@pytest.mark.parametrize("step", ["stage", "publish"])
def test_a_run_that_dies_in_the_middle_of_a_commit_adds_its_rows_once(spark, tmp_path, monkeypatch, step):
    """Killed before a batch is written, or between its rows and its manifest entry: nothing of it is seen, and the next
    run adds it once, also the rows without a date."""
    from chanwh.sources.commits import CommittedTable
    lake, tgt = str(tmp_path / "lake"), str(tmp_path / "t")
    drop(lake, "2024-01-01", "CheMed", [rec(1), {**rec(7), "message_date": None}])
    ingest_increment(spark, lake, tgt)
    drop(lake, "2024-01-02", "CheMed", [rec(1), rec(2), {**rec(8), "message_date": None}])

    class Killed(Exception):
        pass

    def die(self, *a):
        raise Killed("lost the driver")

    real = getattr(CommittedTable, step)
    monkeypatch.setattr(CommittedTable, step, die)
    with pytest.raises(Exception, match="lost the driver"):
        ingest_increment(spark, lake, tgt)
    assert [r[0] for r in table_rows(spark, tgt)] == [1, 7]
    on_disk = spark.read.parquet(tgt).count()
    assert on_disk == (2 if step == "stage" else 4)
    monkeypatch.setattr(CommittedTable, step, real)
    ingest_increment(spark, lake, tgt)
    ingest_increment(spark, lake, tgt)
    assert [r[0] for r in table_rows(spark, tgt)] == [1, 2, 7, 8]
    assert spark.read.parquet(tgt).count() == 4 and message_table(spark, tgt).rows() == 4
    assert not [f for f in os.listdir(tmp_path) if "staging" in f]


def test_commits_are_read_replaced_and_counted(spark, tmp_path):
    from chanwh.streaming.ingest import append_messages
    from chanwh.sources.coerce import coerce_messages
    from chanwh.sources.lake import scan_message_lake
    tgt = str(tmp_path / "t")
    table = message_table(spark, tgt)
    assert not table.exists() and table.rows() == 0 and table.read().count() == 0
    for day in ("01", "02", "03"):
        lake = str(tmp_path / f"lake{day}")
        drop(lake, f"2024-01-{day}", "A", [rec(i, "A", f"2024-01-{day}") for i in range(1, 4)])
        assert append_messages(spark, coerce_messages(scan_message_lake(spark, lake)), tgt, f"day-{day}") == 3
    assert append_messages(spark, coerce_messages(scan_message_lake(spark, lake)), tgt, "day-03") == 0
    assert table.commits() == {"day-01": 3, "day-02": 3, "day-03": 3}
    before = table_rows(spark, tgt)
    assert table.compact() == 3 and list(table.commits().values()) == [9]
    assert table_rows(spark, tgt) == before and table.has("day-01")
    assert append_messages(spark, coerce_messages(scan_message_lake(spark, lake)), tgt, "day-04") == 0   # all skipped
    assert table.compact() == 2 and table.rows() == 9


def test_a_load_counts_nothing_of_its_target(spark, tmp_path, monkeypatch):
    """Rows added come from the write itself; the target is read for its keys alone."""
    from pyspark.sql.classic.dataframe import DataFrame
    from chanwh.plans.pipeline import append_detections
    from chanwh.streaming.ingest import append_messages
    from chanwh.sources.coerce import coerce_messages
    from chanwh.sources.lake import scan_message_lake
    lake, tgt = str(tmp_path / "lake"), str(tmp_path / "t")
    drop(lake, "2024-01-01", "A", [rec(i, "A") for i in range(1, 4)])
    counted = []
    monkeypatch.setattr(DataFrame, "count", lambda self: counted.append(1))
    for added in (3, 0):
        assert append_messages(spark, coerce_messages(scan_message_lake(spark, lake)), tgt) == added
    det = spark.range(5).selectExpr("id as message_id", "'A' as channel_name", "cast(null as string) as image_path", "'' as detected_classes", "0 as total_detections",
                                    "cast(0 as decimal(5,4)) as max_confidence", "'other' as image_category", "timestamp_ntz'2024-01-01' as processed_at",
                                    "timestamp_ntz'2024-01-01' as loaded_at", "'' as _file", "0 as _pos")
    for added in (5, 0):
        assert append_detections(spark, det, str(tmp_path / "d")) == added
    assert not counted


def test_marts_are_written_in_few_files(spark, tmp_path):
    import datetime as dt
    from chanwh.plans.models import build_warehouse
    from tests.test_models import raw
    r = raw(spark, [dict(message_id=i, channel_name="A", message_date=dt.datetime(2024, 1, 1 + i % 8), message_text="x") for i in range(320)])
    build_warehouse(spark, r.repartition(32), None, str(tmp_path / "wh"))
    files = [f for _, _, fs in os.walk(tmp_path / "wh" / "marts" / "fct_messages") for f in fs if f.endswith(".parquet")]
    assert len(files) <= 16


def test_entry_runs(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.columns == ["term", "frequency", "percentage"]
    assert df.count() == 10


@pytest.mark.parametrize("name", ["top_terms", "dim_channels", "quota", "quality_report", "box_rollup", "dup_mart"])
def test_oracle_sf0001(spark, name):
    import __spark_entry__ as E
    con = duckdb.connect()
    for t in ["documents", "events", "lineitem"]:
        con.execute(f"create view {t} as select * from read_parquet('{SF001}/{t}.parquet')")
    df = E.queries()[name](spark, SF001)
    got = sorted(map(repr, (tuple(float(v) if hasattr(v, "as_tuple") else v for v in r) for r in df.collect())))
    res = con.execute(E.oracle_sql()[name])
    assert sorted(df.columns) == sorted(d[0] for d in res.description)
    cols = [d[0] for d in res.description]
    want = sorted(map(repr, (tuple(float(v) if hasattr(v, "as_tuple") else v
                                   for v in (dict(zip(cols, r))[c] for c in df.columns)) for r in res.fetchall())))
    assert got == want


def test_channel_filter_reaches_fact_scan(spark, tmp_path):
    """On a built warehouse the per-channel reports push channel_key into the Parquet scan."""
    from chanwh.plans import reports as R
    from chanwh.plans.models import build_warehouse, open_warehouse
    from chanwh.sources import fixtures as FX
    out = str(tmp_path / "wh")
    build_warehouse(spark, FX.raw_messages(spark, SF001), None, out)
    w = open_warehouse(spark, out)
    assert w.fct_image_detections is None and w.dim_channels.count() == 8
    daily = R.channel_daily(w.fct_messages, w.dim_channels, w.dim_dates, "CheMed", 30, "2024-01-31")
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        daily.explain()
    plan = buf.getvalue()
    assert "PushedFilters: [IsNotNull(channel_key), EqualTo(channel_key," in plan
    assert "dynamicpruningexpression(date_key" in plan          # date partitions pruned at run time
    assert daily.count() > 0


def test_incremental_ingest_one_file_per_batch(spark, tmp_path):
    """Several micro-batches in one run: each batch sees what the previous ones appended."""
    lake, tgt = str(tmp_path / "lake"), str(tmp_path / "t")
    drop(lake, "2024-01-01", "A", [rec(i, "A") for i in range(1, 4)])
    drop(lake, "2024-01-02", "A", [rec(i, "A") for i in range(2, 6)])       # repeats 2, 3
    drop(lake, "2024-01-03", "B", [rec(i, "B") for i in range(1, 3)] + [rec(1, "B")])   # repeat in-file
    ingest_increment(spark, lake, tgt, checkpoint=str(tmp_path / "ck"), max_files_per_trigger=1)
    got = table_rows(spark, tgt)
    assert [(g[0], g[1]) for g in got] == [(1, "A"), (1, "B"), (2, "A"), (2, "B"), (3, "A"), (4, "A"), (5, "A")]


def test_pipeline_with_image_lake(spark, tmp_path):
    """Images without boxes still get a detection row (category 'other'), as an empty detection."""
    lake = str(tmp_path / "lake")
    drop(lake, "2024-01-01", "CheMed", [rec(i) for i in range(1, 4)])
    img = tmp_path / "data" / "raw" / "images" / "CheMed"
    img.mkdir(parents=True)
    for i in (1, 2):
        (img / f"{i}.jpg").write_bytes(b"x")
    boxes = spark.createDataFrame([("CheMed", 2, "bottle", 0.8)],
                                  "channel_name string, message_id long, class_name string, confidence double")
    out = str(tmp_path / "wh")
    counts = run_pipeline(spark, PipelineConfig(lake=lake, out=out, boxes=boxes, as_of="2030-01-01",
                                                image_lake=str(tmp_path / "data" / "raw" / "images")))
    assert counts["detections_loaded"] == 2 and counts["checks_failed"] == {}
    cats = {r.message_id: r.image_category for r in detection_table(spark, os.path.join(out, "raw", "image_detections")).read().collect()}
    assert cats == {1: "other", 2: "product_display"}


def test_envelopes_match_their_rows(spark):
    """Nested responses (rows-only for the driver) carry exactly the oracle-checked flat rows."""
    import __spark_entry__ as E
    from chanwh import catalog
    q, sf = E.queries(), SF001
    top = [tuple(r) for r in q["top_terms"](spark, sf).collect()]
    env = q["top_terms_envelope"](spark, sf).first()
    assert [(p.term, p.frequency, p.percentage) for p in env.products] == top
    assert env.limit == catalog.TOP_LIMIT
    assert env.total_terms == q["top_terms_total"](spark, sf).first().total_terms
    env = q["search_envelope"](spark, sf).first()
    assert [tuple(r) for r in env.results] == [tuple(r) for r in q["search_messages"](spark, sf).collect()]
    assert env.total_found == q["search_count"](spark, sf).first().total_found
    vis = [tuple(r) for r in q["visual_by_channel"](spark, sf).collect()]
    venv = q["visual_envelope"](spark, sf).first()
    assert [tuple(c) for c in venv.channels] == vis
    assert venv.total_images == q["visual_overall"](spark, sf).first().total_images
    daily = [tuple(r) for r in q["channel_daily"](spark, sf).collect()]
    aenv = q["channel_activity_envelope"](spark, sf).first()
    assert [tuple(d) for d in aenv.daily_activity] == daily
    assert aenv.total_messages == q["channel_totals"](spark, sf).first().total_messages
