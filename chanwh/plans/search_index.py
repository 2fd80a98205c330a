"""N3 on a built warehouse: a trigram index of the message fact's files, so that a search reads only files that can
hold a match.

The index has a row (file, trigram) for each three-character string inside the words of the file's
messages, lower-cased as the search compares them, and one row with an empty trigram for each file that was
indexed. It is sorted by trigram, so a lookup reads few row groups. A text that matches a LIKE pattern holds
every literal run of it, hence all trigrams of the runs; a file without one of them has no match. What is
read is searched exactly. Files that the index doesn't know are always read, so an index that is
missing or out of date costs time, not results.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chanwh.functions import exprs as X
from chanwh.sources.tables import table_if_present

INDEX = "file string, trigram string"
#: Of a file's path, what names it inside the mart: its partition folder and its name.
OWN_PATH = r"([^/]+/[^/]+)$"


def index_path(out: str) -> str:
    return os.path.join(out, "marts", "fct_messages_trigrams")


def word_trigrams(word: Column) -> Column:
    """The distinct three-character strings of a word; one pass over its characters."""
    chars = F.regexp_extract_all(word, F.lit("(?s)."), F.lit(0))
    windows = F.transform(F.slice(chars, 1, F.greatest(F.size(chars) - 2, F.lit(0))),
                          lambda c, i: F.concat(c, F.get(chars, i + 1), F.get(chars, i + 2)))
    return F.array_distinct(windows)


def trigram_postings(texts: DataFrame, by: list[str], text: str = "message_text") -> DataFrame:
    """(by..., trigram), distinct, over the words of ``text`` between spaces. Words are made distinct first, in
    the tasks and then by key, so trigrams are cut from each word of a group once."""
    words = texts.select(*by, F.explode(F.split(F.lower(text), " ", -1)).alias("word")).where(F.length("word") >= 3).distinct()
    return words.select(*by, F.explode(word_trigrams(F.col("word"))).alias("trigram")).distinct()


def literal_runs(pattern: str) -> list[str]:
    """The parts of a LIKE pattern between its wildcards, escapes removed."""
    runs, i = [""], 0
    while i < len(pattern):
        if pattern[i] == "\\":
            runs[-1] += pattern[i + 1 : i + 2]
            i += 2
        else:
            if pattern[i] in "%_":
                runs.append("")
            else:
                runs[-1] += pattern[i]
            i += 1
    return [r for r in runs if r]


def query_trigrams(spark: SparkSession, query: str) -> list[str]:
    """Trigrams that every match of a search for ``query`` holds inside a word; none for a short query. The
    pattern is lower-cased by Spark, as the search does it."""
    pattern = spark.createDataFrame([(X.contains_pattern(query),)], "p string").select(F.lower("p")).first()[0]
    words = (w for run in literal_runs(pattern) for w in run.split(" "))
    return sorted({w[i : i + 3] for w in words for i in range(len(w) - 2)})


def build_search_index(fct: DataFrame, out: str) -> None:
    """Index the files of the message fact ``fct`` as it is stored under ``out``."""
    rows = fct.select(F.regexp_extract(F.col("_metadata.file_path"), OWN_PATH, 1).alias("file"), "message_text")
    index = trigram_postings(rows, ["file"]).unionByName(rows.select("file", F.lit("").alias("trigram")).distinct())
    index.repartitionByRange("trigram").sortWithinPartitions("trigram", "file").write.mode("overwrite").parquet(index_path(out))


def searchable_facts(spark: SparkSession, fct: DataFrame, out: str, query: str) -> DataFrame:
    """The message fact ``fct`` stored under ``out``, without files that cannot match ``query``. The candidates
    are looked up when it is called; a query without a trigram, or no index, gives all files."""
    wanted, index = query_trigrams(spark, query), table_if_present(spark, index_path(out), INDEX)
    if not wanted or index is None:
        return fct
    found = index.where(F.col("trigram").isin(["", *wanted])).groupBy("file").agg(F.count(F.lit(1)).alias("n")).collect()
    held = {r["file"]: r["n"] for r in found}   # a number for each file, which the driver lists anyway
    files = fct.inputFiles()
    own = ["/".join(f.split("/")[-2:]) for f in files]
    paths = [f for f, name in zip(files, own) if held.get(name, 0) in (0, len(wanted) + 1)]
    if len(paths) == len(files):
        return fct
    if not paths:
        return fct.where(F.lit(False))
    return spark.read.schema(fct.schema).option("basePath", os.path.join(out, "marts", "fct_messages")).parquet(*paths)
