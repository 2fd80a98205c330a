"""Column helpers: rounding, parsing, patterns, names, classification (FIXTURES §3)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from chanwh.functions import exprs as X


def one(spark, col, data, schema="v string"):
    return [r[0] for r in spark.createDataFrame(data, schema).select(col.alias("o")).collect()]


def test_pct_half_up(spark):
    df = spark.createDataFrame([(9, 32), (1, 800), (0, 0), (1, 3), (2, 3), (5, 8)], "a long, b long")
    got = [r[0] for r in df.select(X.pct_or_zero("a", "b")).collect()]
    assert got == [28.13, 0.13, 0.0, 33.33, 66.67, 62.5]
    got1 = [r[0] for r in df.select(X.pct("a", "b", 1)).collect()]
    assert got1 == [28.1, 0.1, None, 33.3, 66.7, 62.5]


def test_avg_dec2_exact(spark):
    df = spark.createDataFrame([(5, 2), (1, 8), (-5, 2)], "s long, n long")
    got = [str(r[0]) for r in df.select(X.avg_dec2("s", "n")).collect()]
    assert got == ["2.50", "0.13", "-2.50"]


def test_parse_bigint(spark):
    got = one(spark, X.parse_bigint(F.col("v")), [("1.5",), ("x",), (" 7 ",), ("7.0",), (None,), ("-3",)])
    assert got == [None, None, 7, 7, None, -3]


def test_parse_timestamp_offset_to_utc(spark):
    got = one(spark, X.parse_timestamp(F.col("v")),
              [("2026-01-19T10:00:00+03:00",), ("2026-01-19T10:00:00",), ("nope",)])
    assert got == [dt.datetime(2026, 1, 19, 7, 0), dt.datetime(2026, 1, 19, 10, 0), None]


def test_all_digits_anchor(spark):
    got = one(spark, X.is_all_digits(F.col("v")), [("123\n",), ("123",), ("12a",)])
    assert got == [False, True, False]


def test_valid_username(spark):
    got = one(spark, X.valid_username(F.col("v")),
              [("valid_channel",), ("@valid_channel",), ("ab",), ("invalid-channel!",), ("@@abcde",), ("ሰላምሰላም",)])
    assert got == [True, True, False, False, True, True]


def test_safe_file_name(spark):
    got = one(spark, X.safe_file_name(F.col("v")), [("Tikvah | Pharma",), ("ቲክቫህ ፋርማ",), (" a-b_c ",)])
    assert got == ["Tikvah__Pharma", "ቲክቫህ_ፋርማ", "a-b_c"]


def test_contains_pattern():
    assert X.contains_pattern("a_b") == "%a_b%"
    assert X.contains_pattern("50\\%") == "%50\\%%"
    assert X.contains_pattern("\\a") == "%a%"
    with pytest.raises(ValueError):
        X.contains_pattern("ab\\")


def test_like_semantics(spark):
    df = spark.createDataFrame([("axb",), ("50%",), ("500",), ("a",)], "t string")
    def hits(q):
        return sorted(r[0] for r in df.where(F.lower("t").like(X.contains_pattern(q).lower())).collect())
    assert hits("a_b") == ["axb"]
    assert hits("50\\%") == ["50%"]
    assert hits("\\a") == ["a", "axb"]


def test_classify(spark):
    data = [(["person", "bottle"],), (["bottle"],), (["person"],), (["dog"],), ([],), (["pills"],)]
    got = one(spark, X.classify_classes(F.col("v")), data, "v array<string>")
    assert got == ["promotional", "product_display", "lifestyle", "other", "other", "product_display"]


def test_channel_type_and_category(spark):
    got = one(spark, X.channel_type(F.col("v")), [("Tikvah | Pharma",), (" Beauty Hub ",), ("CheMed",), ("src4",)])
    assert got == ["Pharmaceutical", "Cosmetics", "Medical", "Other"]
    got = one(spark, X.normalize_category(F.col("v")), [(" Promotional ",), ("BANNER",), (None,), ("lifestyle",)])
    assert got == ["promotional", "other", "other", "lifestyle"]


def test_surrogate_key_matches_md5(spark):
    import hashlib
    got = one(spark, X.surrogate_key(F.col("v")), [("CheMed",), (None,)])
    assert got == [hashlib.md5(b"CheMed").hexdigest(), hashlib.md5(X.SURROGATE_NULL.encode()).hexdigest()]
