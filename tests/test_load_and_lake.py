"""Insert-or-skip (S6, S7, W2), lake scan (S1), coercion (S3, S4), lake writer (S8),
image lake (S9, S10), detection CSV round trip (S11, S2), record shaping (S12)."""

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from chanwh import schemas as S
from chanwh.operators import load as L
from chanwh.sources import coerce as CO
from chanwh.sources import lake as LK
from tests.conftest import rows

T = dt.datetime
KEY = ["message_id", "channel_name", "message_date"]


def msgs(spark, data, extra="_file string, _pos int"):
    return spark.createDataFrame(data, f"message_id long, channel_name string, message_date timestamp_ntz, "
                                       f"message_text string, {extra}")


def test_insert_or_skip_null_keys_and_first_wins(spark):
    target = msgs(spark, [(1, "A", T(2024, 1, 1), "old", "t", 0)]).drop("_file", "_pos")
    batch = msgs(spark, [
        (1, "A", T(2024, 1, 1), "dup of stored", "f1", 0),     # existing row wins
        (2, "A", None, "null date 1", "f1", 1),                  # NULL keys are distinct: both kept
        (2, "A", None, "null date 2", "f1", 2),
        (3, "A", T(2024, 1, 2), "second", "f2", 0),              # same full key twice: first by (file, pos)
        (3, "A", T(2024, 1, 2), "first", "f1", 5),
    ])
    new = L.insert_or_skip(target, batch, KEY, ["_file", "_pos"])
    assert rows(new, "message_id", "message_text") == [(2, "null date 1"), (2, "null date 2"), (3, "first")]
    assert new.columns == ["message_id", "channel_name", "message_date", "message_text"]


def test_insert_or_skip_idempotent(spark):
    target = msgs(spark, [], "seq int").drop("seq")
    batch = msgs(spark, [(i, "A", T(2024, 1, 1 + i % 3), f"m{i}", 0) for i in range(20)], "seq int")
    first = L.insert_or_skip(target, batch, KEY, ["seq"])
    assert first.count() == 20
    assert L.insert_or_skip(first, batch, KEY, ["seq"]).count() == 0


def test_detection_keys_rejected(spark):
    t = spark.createDataFrame([], "message_id long, channel_name string, x int")
    b = spark.createDataFrame([(None, "A", 1, 0), (1, None, 1, 0), (1, "A", 1, 0), (1, "A", 2, 1)],
                              "message_id long, channel_name string, x int, seq int")
    got = rows(L.insert_or_skip(t, b, ["message_id", "channel_name"], ["seq"], reject_null_keys=True))
    assert got == [(1, "A", 1)]


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def test_scan_message_lake(spark, tmp_path):
    root = str(tmp_path / "lake")
    write(f"{root}/2024-01-01/a.json", '[7, {"message_id": 3}]')
    write(f"{root}/2024-01-01/b.json", '{"message_id": 9, "channel_name": "B", "views": "12"}')
    write(f"{root}/2024-01-02/c.json", '[{"message_id": 4, "channel_name": "C"')        # truncated → skipped
    write(f"{root}/2024-01-02/d.txt", '[{"message_id": 5}]')                             # not *.json
    write(f"{root}/2024-01-03/e.json", json.dumps([{"message_id": "1.5"}, {"message_id": " 7 ",
                                                   "message_date": "2026-01-19T10:00:00+03:00",
                                                   "has_media": True}], indent=2))
    raw = CO.coerce_messages(LK.scan_message_lake(spark, root))
    got = rows(raw, "message_id", "channel_name", "views", "message_date", "has_media")
    assert got == [(3, None, None, None, None), (7, None, None, T(2026, 1, 19, 7), True),
                   (9, "B", 12, None, None), (None, None, None, None, None)]
    from chanwh.operators.profile import lake_channel_counts
    assert rows(lake_channel_counts(LK.scan_message_lake(spark, root))) == [("B", 1)]


def test_lake_writer_merges_partitions(spark, tmp_path):
    root = str(tmp_path / "lake")
    recs = spark.createDataFrame([
        (1, "Tikvah | Pharma", "2024-01-01T10:00:00+00:00", "a"),
        (2, "Tikvah | Pharma", "2024-01-01T11:00:00+00:00", "b"),
        (3, "ሰላም ቻናል", None, "c"),
    ], "message_id long, channel_name string, message_date string, message_text string")
    L.write_message_lake(recs, root, as_of="2024-02-01")
    dirs = sorted(os.path.relpath(d, root) for d, _, fs in os.walk(root) if any(f.endswith(".json") for f in fs))
    assert dirs == ["dt=2024-01-01/channel=Tikvah__Pharma", "dt=2024-02-01/channel=ሰላም_ቻናል"]
    again = spark.createDataFrame([(2, "Tikvah | Pharma", "2024-01-01T11:00:00+00:00", "b2"),
                                   (4, "Tikvah | Pharma", "2024-01-01T12:00:00+00:00", "d")],
                                  "message_id long, channel_name string, message_date string, message_text string")
    assert L.write_message_lake(again, root, merge=True, as_of="2024-02-01") == 1
    for scan in (LK.scan_message_lake, LK.scan_written_lake):
        back = CO.coerce_messages(scan(spark, root))
        assert rows(back, "message_id", "message_text") == [(1, "a"), (2, "b"), (3, "c"), (4, "d")]


def test_first_merge_creates_the_lake(spark, tmp_path):
    root = "file://" + str(tmp_path / "new" / "lake")
    recs = spark.createDataFrame([(1, "A", "2024-01-01T10:00:00"), (2, "A", None)], "message_id long, channel_name string, message_date string")
    assert L.write_message_lake(recs, root, merge=True, as_of="2024-02-01") == 2
    assert L.write_message_lake(recs, root, merge=True, as_of="2024-02-01") == 0
    assert not [f for f in os.listdir(tmp_path / "new") if "staging" in f]


def test_merge_into_array_files(spark, tmp_path):
    """A lake of indented array files, a file for a day and a channel: their records are known, others are added; both forms
    are read together, and a file of another day is not opened."""
    root = tmp_path / "lake"
    for day, name, text in [("2024-01-01", "Tikvah__Pharma", json.dumps([{"message_id": 1, "channel_name": "Tikvah | Pharma"}, {"message_id": 2}], indent=2)),
                            ("2024-01-01", "ሰላም_ቻናል", json.dumps({"message_id": 5}, indent=2)), ("2024-01-02", "A+B c", "[{\"message_id\": 1}]"),
                            ("2024-01-01", "broken", "{not json"), ("2023-12-31", "Tikvah__Pharma", "[{\"message_id\": 3}]")]:
        (root / day).mkdir(parents=True, exist_ok=True)
        (root / day / f"{name}.json").write_text(text, encoding="utf-8")
    recs = spark.createDataFrame([(i, c, f"{day}T10:00:00") for i, c, day in [
        (1, "Tikvah | Pharma", "2024-01-01"), (2, "Tikvah | Pharma", "2024-01-01"), (3, "Tikvah | Pharma", "2024-01-01"), (5, "ሰላም ቻናል", "2024-01-01"),
        (6, "broken", "2024-01-01"), (1, "Tikvah | Pharma", "2024-01-02")]], "message_id long, channel_name string, message_date string")
    assert L.write_message_lake(recs, str(root), merge=True) == 3          # 3, 6, and 1 of the other day
    assert L.write_message_lake(recs, str(root), merge=True) == 0
    stored = L.stored_ids(spark, str(root), ["2024-01-01"])
    assert rows(stored) == [("2024-01-01", "Tikvah__Pharma", "1"), ("2024-01-01", "Tikvah__Pharma", "2"), ("2024-01-01", "Tikvah__Pharma", "3"),
                            ("2024-01-01", "broken", "6"), ("2024-01-01", "ሰላም_ቻናል", "5")]
    ids = sorted(r.message_id for r in LK.scan_message_lake(spark, str(root)).collect())
    assert ids == ["1", "1", "1", "2", "3", "3", "5", "6"]


def _lake_of_forms(root):
    """Files of all forms and kinds of damage; the names of those that parse, with their records in order."""
    os.makedirs(root)
    recs = [{"message_id": i, "channel_name": "A", "message_text": f"line\n  }}{{ \" , {i}", "views": {"a": [{"b": 1}, {"c": "\n  }"}]}} for i in range(400)]
    indented, text = json.dumps(recs, indent=2, ensure_ascii=False), {}
    text["indented"] = indented
    text["mixed"] = indented.replace("\n]", ",\n  7,\n  null\n]").replace("[", "[\n  \"x\",", 1)
    text["compact"], text["wide"], text["narrow"] = json.dumps(recs), json.dumps(recs, indent=4), json.dumps(recs, indent=1)
    text["crlf"] = indented.replace("\n", "\r\n")
    text["lines"] = "\n".join(json.dumps(r) for r in recs)
    text["single"] = json.dumps({"message_id": 1, "views": {"x": {"y": 1}}}, indent=2)
    text["empty"] = "[\n]"
    good = {"indented": 400, "mixed": 400, "compact": 400, "wide": 400, "narrow": 400, "crlf": 400, "lines": 400, "single": 1, "empty": 0}
    half = indented.index('"message_id": 200')
    text["truncated"], text["cut_at_a_record"] = indented[: half + 5], indented[: indented.rindex("\n  },", 0, half)] + "\n  }"
    text["damaged"] = indented[:half] + "oops " + indented[half:]
    text["no_comma"] = indented[: indented.index("\n  },", half)] + indented[indented.index("\n  },", half):].replace("},", "}", 1)
    text["blank"] = " "
    for name, t in text.items():
        with open(f"{root}/{name}.json", "w", encoding="utf-8", newline="") as f:
            f.write(t)
    return good


def test_large_arrays_are_read_in_pieces(spark, tmp_path, monkeypatch):
    """All forms in pieces, with splits of a few kilobytes: the same records in the same order as whole."""
    root = str(tmp_path / "lake")
    good = _lake_of_forms(root)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        pieces = LK.read_lake_pieces(spark, root, 0)
        tasks = pieces.groupBy("_file", F.spark_partition_id().alias("p")).count().groupBy(F.regexp_extract("_file", "([a-z_]+).json", 1)).count().collect()
        assert dict(map(tuple, tasks))["indented"] >= 5
        got = LK.scan_message_lake(spark, root, whole_file_bytes=0).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    found = {}
    for r in sorted(got, key=lambda r: r["_pos"]):
        found.setdefault(os.path.basename(r["_file"])[:-5], []).append(r["message_id"])
    want = {name: [str(i) for i in range(n)] if n > 1 else ["1"] for name, n in good.items() if n}
    assert found == want
    whole = LK.scan_message_lake(spark, root).drop("_pos").collect()
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(key, whole)) == sorted(key(r[:-1]) for r in got)


def test_files_of_either_size_are_scanned_once(spark, tmp_path):
    root = str(tmp_path / "lake")
    good = _lake_of_forms(root)
    sizes = sorted(os.path.getsize(f"{root}/{f}") for f in os.listdir(root))
    got = LK.scan_message_lake(spark, root, whole_file_bytes=sizes[len(sizes) // 2])
    assert got.count() == sum(good.values())


def test_lake_merge_reads_the_batch_days_and_writes_few_files(spark, tmp_path):
    root = "file://" + str(tmp_path / "lake")
    schema = "message_id long, channel_name string, message_date string, message_text string"
    recs = spark.createDataFrame([(i, "A", f"2024-01-{1 + i % 4:02d}T10:00:00", "x") for i in range(400)], schema)
    assert L.write_message_lake(recs.repartition(16), root) == 400
    assert L.write_message_lake(recs.repartition(16), root, merge=True) == 0
    files = [f for _, _, fs in os.walk(tmp_path / "lake") for f in fs if f.endswith(".json")]
    assert len(files) <= 8


def test_image_lake(spark, tmp_path):
    root = tmp_path / "data" / "raw" / "images"
    for rel in ["Tikvah | Pharma/123.jpg", "Tikvah | Pharma/abc.jpg", "CheMed/5.png", "CheMed/6.gif"]:
        p = root / rel
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_bytes(b"\xff\xd8 not really a jpeg")
    imgs = LK.scan_images(spark, str(root))
    parsed = LK.parse_image_path(imgs)
    assert rows(parsed, "channel_name", "message_id") == [("CheMed", 5), ("Tikvah | Pharma", 123)]
    assert rows(LK.images_per_channel(imgs)) == [("CheMed", 1), ("Tikvah | Pharma", 1)]


def test_detection_csv_round_trip(spark, tmp_path):
    path = str(tmp_path / "det")
    df = spark.createDataFrame([(1, "A", "img", "bottle, person", 2, 0.91234, "promotional"),
                                (2, "A", None, "", 0, 0.0, "other")],
                               "message_id long, channel_name string, image_path string, detected_classes string, "
                               "total_detections int, max_confidence double, image_category string")
    L.write_detections_csv(df, path)
    back = CO.coerce_detections(LK.scan_detections_csv(spark, path))
    got = rows(back, "message_id", "image_path", "detected_classes", "total_detections", "max_confidence")
    assert [g[:4] for g in got] == [(1, "img", "bottle, person", 2), (2, None, None, 0)]
    assert str(got[0][4]) == "0.9123" and back.schema["max_confidence"].dataType == S.RAW_DETECTIONS["max_confidence"].dataType


def test_csv_keeps_spaces_and_declared_line_feeds(spark, tmp_path):
    path = str(tmp_path / "det")
    df = spark.createDataFrame([(1, " Beauty Hub ", "two\nlines"), (2, "B", 'say "x", y')], "message_id long, channel_name string, image_path string")
    L.write_detections_csv(df, path)
    back = LK.scan_detections_csv(spark, path, quoted_line_feeds=True)
    assert rows(back, "message_id", "channel_name", "image_path") == [("1", " Beauty Hub ", "two\nlines"), ("2", "B", 'say "x", y')]
    assert LK.scan_detections_csv(spark, path).count() == 3               # line by line, a line feed ends a row


def test_csv_is_read_by_several_tasks_in_order(spark, tmp_path):
    path = str(tmp_path / "det")
    L.write_detections_csv(spark.range(2000).selectExpr("id as message_id", "'A' as channel_name").coalesce(1), path)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        back = LK.scan_detections_csv(spark, path)
        assert back.select(F.spark_partition_id()).distinct().count() >= 5
        assert [r.message_id for r in back.orderBy("_file", "_pos").collect()] == [str(i) for i in range(2000)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_shape_message_records(spark):
    api = spark.createDataFrame([
        (10, "CheMed", T(2024, 1, 1, 9), None, "photo", None, 3, True, 9),
        (11, "CheMed", T(2024, 1, 1, 9), "hi", None, 5, None, False, 7),
    ], "id long, channel_name string, date timestamp, text string, media_type string, views int, forwards int, "
       "is_reply boolean, reply_to_msg_id long")
    out = L.shape_message_records(api, scraped_at=T(2024, 1, 2))
    got = rows(out, "message_id", "message_text", "has_media", "image_path", "views", "forwards", "reply_to_msg_id")
    assert got == [(10, "", True, "data/raw/images/CheMed/10.jpg", 0, 3, 9), (11, "hi", False, None, 5, 0, None)]
    assert out.where(F.col("message_id") == 10).first().message_date == "2024-01-01T09:00:00+00:00"
    assert out.where(F.col("message_id") == 10).first().scraped_at == "2024-01-02T00:00:00"
