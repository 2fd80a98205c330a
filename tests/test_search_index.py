"""N3's trigram index: candidates by file, exact results, and what falls back to all files."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from chanwh.plans import reports as R
from chanwh.plans import search_index as SX
from chanwh.plans.models import build_warehouse, open_warehouse
from tests.test_models import raw
from tests.test_plans import plan

DAYS = 6


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    """A warehouse with a file a day, each with words of its own, and the texts by day."""
    out = str(tmp_path_factory.mktemp("wh"))
    rng, texts = random.Random(1), {}
    rows = []
    for i in range(240):
        day = i % DAYS
        words = ["common", "Aspirin" if day == 2 else "tablet", f"day{day}word", rng.choice(["x", "Ärzte ΟΔΟΣ", "50%", "a_b", "tab\tnew\nline", "ab"])]
        texts.setdefault(day, []).append((i, " ".join(words)))
        rows.append(dict(message_id=i, channel_name="A" if i % 2 else "B", message_date=dt.datetime(2024, 1, 1 + day, i % 24), message_text=texts[day][-1][1]))
    build_warehouse(spark, raw(spark, rows), None, out)
    return out, open_warehouse(spark, out), {i: t for own in texts.values() for i, t in own}


def searched(spark, built, query, channel=None):
    out, w, _ = built
    facts = SX.searchable_facts(spark, w.fct_messages, out, query)
    full = R.search_messages(w.fct_messages, w.dim_channels, query, 100, channel).collect()
    assert R.search_messages(facts, w.dim_channels, query, 100, channel).collect() == full
    total = R.search_count(facts, w.dim_channels, query, channel).first()
    assert total == R.search_count(w.fct_messages, w.dim_channels, query, channel).first()
    return len(facts.inputFiles()), total[0]


@pytest.mark.parametrize("query, files, found", [
    ("aspirin", 1, 40), ("ASPI", 1, 40), ("common", DAYS, 240), ("day3word", 1, 40), ("day4word common", 1, 0), ("y_word", DAYS, 240),
    ("day1%spirin", 0, 0), ("nothing like it", 0, 0), ("common%tablet%day5", 1, 40), ("ab", DAYS, None), ("a_", DAYS, None), ("on as", DAYS, 40),
    ("οδοσ", None, None), ("ärzte", None, None), ("50\\%", None, None), ("tab\tnew\nl", None, None), ("\\a\\s\\p\\i\\r", 1, 40)])
def test_a_search_reads_files_that_can_match(spark, built, query, files, found):
    read, total = searched(spark, built, query)
    assert files is None or read == files
    assert found is None or total == found
    searched(spark, built, query, channel="A")


def test_the_scan_lists_candidate_files_only(spark, built):
    out, w, _ = built
    facts = SX.searchable_facts(spark, w.fct_messages, out, "day3word")
    assert "InMemoryFileIndex(1 paths)" in plan(facts) and "date_key=20240104" in facts.inputFiles()[0]
    index = spark.read.schema(SX.INDEX).parquet(SX.index_path(out)).where(F.col("trigram").isin("asp", "spi"))
    assert "PushedFilters: [In(trigram" in plan(index)


def test_files_unknown_to_the_index_are_read(spark, built, tmp_path):
    texts = built[2]
    other = str(tmp_path / "wh")
    rows = [dict(message_id=i, channel_name="A", message_date=dt.datetime(2024, 1, 1 + i % DAYS), message_text=t) for i, t in texts.items()]
    build_warehouse(spark, raw(spark, rows), None, other)
    first = open_warehouse(spark, other).fct_messages.where("message_id = 0")
    late = first.withColumns({"message_id": F.lit(999).cast("long"), "message_text": F.lit("late Aspirin")})
    late.write.mode("append").partitionBy("date_key").parquet(f"{other}/marts/fct_messages")
    fresh = open_warehouse(spark, other)
    facts = SX.searchable_facts(spark, fresh.fct_messages, other, "aspirin")
    assert len(facts.inputFiles()) == 2
    assert R.search_count(facts, fresh.dim_channels, "aspirin").first()[0] == 41


def test_trigrams_of_a_query(spark):
    assert SX.query_trigrams(spark, "Tab_lets 50\\% ab") == ["50%", "ets", "let", "tab"]
    assert SX.query_trigrams(spark, "a_bc%de") == [] and SX.literal_runs("%a\\%b_c%") == ["a%b", "c"]
    words = spark.createDataFrame([("abcab",), ("🙂é日x",), ("ab",), ("",)], "w string")
    assert [r[0] for r in words.select(SX.word_trigrams(F.col("w"))).collect()] == [["abc", "bca", "cab"], ["🙂é日", "é日x"], [], []]
