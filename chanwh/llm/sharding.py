"""Uniform random sharding with exact shard sizes (law ``rows``), DataFrame functions only.

A uniform shuffle is drawn in two steps that need no global sort. First the *communication
matrix*: how many rows of each source block go to each shard. Under a uniform shuffle its rows
are multivariate hypergeometric, so it is drawn from the block sizes alone, on the driver; it
has ``blocks x shards`` counts, both of which are bounded by parameters. Then each block
permutes its rows locally, deals them out by its row of the matrix, and after the exchange each
shard permutes what it received. Any shard then holds exactly ``n // shards`` or one more rows.

Blocks and permutations come from hashes of the row's own values and a seed, never from task
numbers, so a task that runs again after an executor is lost makes the same rows.

Equal texts form groups that this law spreads like any other rows: with counts at most one
apart a group of copies larger than a shard could not stay together.
"""

from __future__ import annotations

import json
import math

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chanwh.llm.shared import partitions, text_or_empty, written

#: Bound on the rows of the communication matrix, and rows of a block or of a shard's part
#: that one task sorts.
MAX_BLOCKS, ROWS_PER_TASK = 4096, 1_000_000


def hypergeometric(rng: np.random.Generator, good: int, bad: int, drawn: int) -> int:
    """How many of ``drawn`` rows fall among ``good`` of ``good + bad``. numpy's own generator ends at
    10^9 rows; beyond it the distribution is summed around its mode by the ratio of neighbours."""
    if drawn == 0 or good == 0:
        return 0
    if good < 10**9 and bad < 10**9:
        return int(rng.hypergeometric(good, bad, drawn))
    low, high = max(0, drawn - bad), min(drawn, good)
    total = good + bad
    mode = min(max((drawn + 1) * (good + 1) // (total + 2), low), high)
    spread = 14 * math.isqrt(int(drawn * (good / total) * (bad / total)) + 1) + 20
    first, last = max(low, mode - spread), min(high, mode + spread)
    k = np.arange(first, last, dtype=np.float64)
    steps = np.log(good - k) + np.log(drawn - k) - np.log(k + 1) - np.log(bad - drawn + k + 1)
    logs = np.concatenate([[0.0], np.cumsum(steps)])
    weights = np.exp(logs - logs.max())
    return first + int(np.searchsorted(np.cumsum(weights), rng.random() * weights.sum(), side="right"))


def communication_matrix(sizes: list[int], shards: int, seed: int) -> list[list[int]]:
    """Rows that each block sends to each shard: the margins are the block sizes and the shard
    sizes (at most one apart; which shards get the odd rows is drawn too)."""
    rng = np.random.default_rng(seed)
    n = sum(sizes)
    left = [n // shards] * shards
    for s in rng.permutation(shards)[: n % shards]:
        left[int(s)] += 1
    matrix = []
    for size in sizes:
        row, total = [], sum(left)
        for s in range(shards):
            take = hypergeometric(rng, left[s], total - left[s], size)
            total -= left[s]
            left[s] -= take
            size -= take
            row.append(take)
        matrix.append(row)
    return matrix


def shard_rows(docs: DataFrame, shards: int, seed: int = 17, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, ``size`` (UTF-8 bytes plus 16), ``text_crc32``, ``law``,
    ``shard``, ``slot`` (place in the shard, from 0) and ``grown_shard`` (null under this law).

    A null text has size 16 and the CRC of nothing; a null id is an id like any other. Repeated
    rows each get a place of their own. No rows: no shards, an empty result. Other columns of
    ``docs`` are not read, so their names cannot clash.
    """
    spark = docs.sparkSession
    text = text_or_empty(text_col)
    base = written(docs.select(
        F.col(id_col).alias("id"),
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    ), "shard-base")
    row = [F.col("id"), F.col("size"), F.col("text_crc32")]
    key = lambda name: F.xxhash64(F.lit(f"{seed}:{name}"), *row)

    n = base.count()
    tasks = max(2 * partitions(spark), math.ceil(n / ROWS_PER_TASK))
    blocks = min(MAX_BLOCKS, tasks)
    parts = min(MAX_BLOCKS, math.ceil(tasks / shards))
    base = base.withColumn("block", F.pmod(key("block"), F.lit(blocks)).cast("int"))
    # at most MAX_BLOCKS counts reach the driver, and the matrix goes back as one literal
    sizes = dict(base.groupBy("block").count().collect())
    order = sorted(sizes)
    matrix = communication_matrix([sizes[b] for b in order], shards, seed)
    ends = json.dumps([{"block": b, "ends": np.cumsum(m).tolist()} for b, m in zip(order, matrix)])
    table = spark.range(1).select(F.inline(F.from_json(F.lit(ends), "array<struct<block:int,ends:array<bigint>>>")))

    local = Window.partitionBy("block").orderBy(key("local"), *row)
    dealt = (base.withColumn("place", F.row_number().over(local) - 1)
             .join(F.broadcast(table), "block")  # MAX_BLOCKS x shards numbers at most
             .withColumn("shard", F.size(F.filter("ends", lambda e: e <= F.col("place"))).cast("int"))
             .select("id", "size", "text_crc32", "shard", F.pmod(key("part"), F.lit(parts)).cast("int").alias("part")))
    dealt = written(dealt, "shard-dealt")

    # a shard is ordered by a random part and by a random key in it; the parts' first slots come
    # from their counts, so no task sorts a whole shard
    counts = dealt.groupBy("shard", "part").count()
    first = counts.select("shard", "part", (F.sum("count").over(Window.partitionBy("shard").orderBy("part")) - F.col("count")).alias("first"))
    in_part = Window.partitionBy("shard", "part").orderBy(key("slot"), *row)
    return (dealt.withColumn("rank", F.row_number().over(in_part) - 1)
            .join(F.broadcast(first), ["shard", "part"])  # shards x parts rows, both bounded
            .select(F.col("id").alias(id_col), "size", "text_crc32", F.lit("rows").alias("law"), "shard",
                    (F.col("first") + F.col("rank")).alias("slot"), F.lit(None).cast("int").alias("grown_shard")))
