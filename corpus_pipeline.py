"""A corpus in five stages: toxic documents go, exact copies go, near copies go, documents with
benchmark passages go, and what is left is packed into training sequences.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; its result is
written as Parquet and read again as the next stage's documents, so a lost executor costs at most
the stage that runs. All stages but the last return the columns of ``docs``, whatever they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chanwh.llm import decontaminate, exact_dedup, ngram_join, queries, toxicity
from chanwh.llm.shared import keep_rows, small, text_or_empty, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic (operator 7)."""
    scored = toxicity.score_toxicity(docs, queries.table(spark, sf_dir, "labels"))
    decisions = scored.select(F.col("doc_id").alias("id"), F.col("text_hash").alias("key"), (F.col("predicted") == 0).alias("kept"))
    return keep_rows(docs, decisions, F.xxhash64(text_or_empty("text")))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts equal but for the case of A-Z, the row with the largest id (operator 2)."""
    judged = exact_dedup.deduplicate(docs)
    decisions = judged.select(F.col("doc_id").alias("id"), F.col("text_sha256").alias("key"), "kept")
    return keep_rows(docs, decisions, exact_dedup.digest("text"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of similar texts, the one with the smallest id (operator 4)."""
    joined = ngram_join.similar_texts(docs)
    decisions = joined.select(F.col("doc_id").alias("id"), F.col("text_sha256").alias("key"), "kept")
    return keep_rows(docs, decisions, F.sha2(text_or_empty("text"), 256))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark (operator 8)."""
    leaks = decontaminate.find_leaks(docs, queries.table(spark, sf_dir, "benchmark"))
    found = written(leaks.select(F.col("doc_id").alias("__llm_id"), F.col("text_hash").alias("__llm_key")).distinct(), "leaks")
    marked = docs.withColumn("__llm_own", F.xxhash64("text"))
    kept = marked.join(small(found), marked["doc_id"].eqNullSafe(found["__llm_id"]) & (marked["__llm_own"] == found["__llm_key"]), "left_anti")
    return kept.drop("__llm_own")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all that is left, packed into sequences (operator 10)."""
    return queries.pack(docs)


STAGES = [("toxicity", drop_toxic), ("exact_dedup", drop_copies), ("near_dedup", drop_near_copies), ("decontaminate", drop_leaks), ("pack", pack)]

#: Scores, signatures and packing are beyond SQL; the tests compare each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = queries.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
