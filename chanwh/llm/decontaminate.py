"""Benchmark decontamination by SimHash of item-sized windows, DataFrame functions only.

1. Documents and items become words (lower case; anything but letters and digits separates) and
   hashes of five-word shingles.
2. Windows have as many words as an item. They start where a shared shingle puts the item's start
   (its own place minus its place in the item), and at every shared shingle itself: a window that starts
   elsewhere keeps all its shared shingles when it moves right to the next one. Left out is what cannot
   reach the similarity (too few shared shingles) or adds none to the window before it.
3. Each window gets a 64-bit SimHash of its shingles, in which the k-th occurrence of a shingle votes as an
   element of its own: the similarity of counts is then one of sets, whose angle bounds the bits that
   differ, however often shingles repeat. Items of the window's size are searched by a
   multi-index: the fingerprint is cut into blocks, and of two fingerprints within the radius at
   least one block differs in at most ``radius // blocks`` bits. Item blocks are stored with all
   such changes, so an equality join on (size, block, value) finds every item within the radius.
4. What it finds is verified exactly: the similarity of two windows is the sum of the smaller over
   the sum of the larger count of each shingle (shingles weigh as often as they occur).

The benchmark is broadcast only while its rows stay under a stated bound, otherwise its joins
shuffle. Windows are at most twice as many as shared shingles; nothing is collected.
"""

from __future__ import annotations

import itertools
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chanwh.llm.shared import small as small_up_to
from chanwh.llm.shared import written

WORDS = 5
BITS, BLOCKS = 64, 8
#: A window: its document's id and text (by hash), first word and number of shingles.
KEY = ["id", "t", "start", "size"]
#: Rows of a side that is broadcast: shingles, item blocks (each of 16 to 32 bytes), or windows.
BROADCAST_ROWS = 1_000_000


def words(text: str) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(F.col(text).cast("string"), F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def with_shingles(df: DataFrame, text: str) -> DataFrame:
    """Adds ``sh``: the shingles of ``text`` in order (empty for texts under five words)."""
    hashed = df.withColumn("w", F.transform(words(text), lambda w: F.xxhash64(w))).drop(text)
    at = [lambda i, k=k: F.get(F.col("w"), i + k) for k in range(WORDS)]
    grams = F.transform(F.sequence(F.lit(0), F.size("w") - WORDS), lambda i: F.xxhash64(*(f(i) for f in at)))
    return hashed.withColumn("sh", F.when(F.size("w") >= WORDS, grams).otherwise(F.array().cast("array<bigint>"))).drop("w")


def exploded(df: DataFrame, keys: list[str], array: str) -> DataFrame:
    """(keys, at, h): the outer form, because for the inner one Spark tests the array's size in a filter of
    its own below, which would compute the shingles many times over."""
    return df.select(*keys, F.posexplode_outer(array).alias("at", "h")).where(F.col("h").isNotNull())


def occurrences(counts: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, h): of each shingle ``h`` that a group has ``c`` times, a hash for every occurrence."""
    each = counts.select(*keys, "h", F.explode(F.sequence(F.lit(1).cast("bigint"), "c")).alias("k"))
    return each.select(*keys, F.when(F.col("k") == 1, F.col("h")).otherwise(F.xxhash64("h", "k")).alias("h"))


def fingerprint(df: DataFrame, keys: list[str]) -> DataFrame:
    """SimHash of the hashes ``h`` of each group: a bit is set if more than half of them have it.
    Each of 32 sums counts two bits, in the halves of a long."""
    half = F.lit(0x0000000100000001)
    sums = [F.sum(F.shiftrightunsigned("h", k).bitwiseAND(half)).alias(f"s{k}") for k in range(32)]
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("m"), *sums)
    bits = []
    for k in range(32):
        low, high = F.col(f"s{k}").bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(f"s{k}", 32)
        bits += [F.when(c * 2 > F.col("m"), F.shiftleft(F.lit(1).cast("bigint"), b)).otherwise(F.lit(0).cast("bigint")) for c, b in ((low, k), (high, k + 32))]
    while len(bits) > 1:
        bits = [a.bitwiseOR(b) for a, b in zip(bits[::2], bits[1::2])]
    return counted.select(*keys, "m", bits[0].alias("print"))


def radius_for(similarity: float) -> int:
    """Bits within which fingerprints of this similarity lie, but for about one in 10,000: the angle between
    the sets of occurrences gives the chance of a bit to differ, four standard deviations are added."""
    p = math.acos(2 * similarity / (1 + similarity)) / math.pi
    return math.ceil(BITS * p + 4 * math.sqrt(BITS * p * (1 - p)))


def block_values(column: str) -> Column:
    width = BITS // BLOCKS
    value = lambda k: F.shiftrightunsigned(column, k * width).bitwiseAND(F.lit((1 << width) - 1)).cast("int")
    return F.array(*(F.struct(F.lit(k).alias("block"), value(k).alias("value")) for k in range(BLOCKS)))


def changes(radius: int) -> list[int]:
    """All masks of a block with at most ``radius // BLOCKS`` bits."""
    width = BITS // BLOCKS
    return [sum(1 << b for b in bits) for n in range(min(width, radius // BLOCKS) + 1) for bits in itertools.combinations(range(width), n)]


def windows_of(placed: DataFrame, similarity: float) -> DataFrame:
    """(id, t, start, size): for each document and size the windows among which is the most similar one of
    every item of that size. ``placed``: (id, t, length, size, at, place), a shared shingle and its place in an
    item; ``length`` is the document's number of shingles.

    Both kinds of starts (see 2. above) are counted by running sums: a window's shared shingles are those
    before its end less those before its start. Fewer than similarity x (m + size) / (1 + similarity) of its m
    shingles are too few for any item. A window that ends within the document is no better than the one
    from the shared shingle before if no other shared shingle ends it.
    """
    group = ["id", "t", "size"]
    own = F.struct(F.col("at").alias("at"), F.lit(1).alias("hit"), F.lit(0).alias("seeded"))
    put = F.struct(F.greatest(F.col("at") - F.col("place"), F.lit(0)).alias("at"), F.lit(0).alias("hit"), F.lit(1).alias("seeded"))
    starts = placed.select(*group, "length", F.explode(F.array(own, put)).alias("s"))
    starts = starts.groupBy(*group, "length", F.col("s.at").alias("start")).agg(F.max("s.hit").alias("hit"), F.max("s.seeded").alias("seeded"))
    # an event at the start of each window and one just behind its end, which comes before a start there
    begin = F.struct(F.col("start").alias("pos"), F.lit(1).alias("begins"), F.col("hit").alias("one"))
    end = F.struct((F.col("start") + F.col("size")).alias("pos"), F.lit(0).alias("begins"), F.lit(0).alias("one"))
    events = starts.select(*group, "length", "start", "hit", "seeded", F.explode(F.array(begin, end)).alias("e"))
    running = Window.partitionBy(*group).orderBy("e.pos", "e.begins").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    events = events.withColumn("sum", F.sum("e.one").over(running))
    counted = events.groupBy(*group, "length", "start", "hit", "seeded").agg(
        F.max(F.when(F.col("e.begins") == 1, F.col("sum") - F.col("hit"))).alias("before"), F.max(F.when(F.col("e.begins") == 0, F.col("sum"))).alias("upto"))
    earlier = Window.partitionBy(*group).orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    counted = counted.withColumn("last", F.coalesce(F.max(F.when(F.col("hit") == 1, F.col("upto"))).over(earlier), F.lit(-1)))
    m = F.least(F.col("size"), F.col("length") - F.col("start"))
    enough = (F.col("upto") - F.col("before")) * (1 + similarity) + 1e-6 >= (m + F.col("size")) * similarity
    best = (F.col("seeded") == 1) | (F.col("upto") > F.col("last")) | (F.col("start") + F.col("size") > F.col("length"))
    return counted.where(enough & best).select("id", "t", "start", "size")


def find_leaks(docs: DataFrame, benchmark: DataFrame, similarity: float = 0.8, id_col: str = "doc_id", text_col: str = "text",
               item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per document and item found in it: id, item id, ``similarity`` of the most similar
    window, ``start_word``, ``n_words``, ``bits`` (Hamming distance), ``text_hash`` of the document's
    text (``xxhash64``; null texts as they are). Clean documents have no row.

    Null texts are empty; a text or item under five words has no shingle and matches nothing. Rows with
    the same id and different texts are documents of their own, so are rows with a null id; those with
    equal ids and texts are one. Equal items are found each. Empty tables: no rows.
    """
    small = lambda df: small_up_to(df, BROADCAST_ROWS)
    items = benchmark.select(F.col(item_col).alias("item"), F.col(item_text).alias("text")).withColumn("no", F.monotonically_increasing_id())
    items = written(with_shingles(items, "text").withColumn("size", F.size("sh")), "items").where(F.col("size") > 0)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).withColumn("t", F.xxhash64("text"))

    # windows from the shared shingles
    seeds = items.select("size", F.posexplode("sh").alias("place", "h")).groupBy("h", "size", "place").count().drop("count")
    seeds = small(written(seeds, "seeds"))
    placed = exploded(with_shingles(texts, "text").withColumn("length", F.size("sh")), ["id", "t", "length"], "sh").join(seeds, "h")
    windows = written(windows_of(placed, similarity), "windows")

    # their shingles, from the texts that have one; repeated rows give the same ones
    wanted = windows.groupBy("id", "t").agg(F.collect_set(F.struct("start", "size")).alias("windows"))
    wanted = small(written(wanted, "wanted"))
    found = texts.join(wanted, texts["id"].eqNullSafe(wanted["id"]) & (texts["t"] == wanted["t"]))
    found = with_shingles(found.select(texts["id"].alias("id"), texts["t"].alias("t"), "text", "windows"), "text")
    inside = found.select("id", "t", "sh", F.explode("windows").alias("w"))
    inside = exploded(inside.select("id", "t", "w.start", "w.size", F.slice("sh", F.col("w.start") + 1, F.col("w.size")).alias("sh")), KEY, "sh")
    inside = written(inside.distinct().groupBy(*KEY, "h").agg(F.count(F.lit(1)).alias("c")), "window-shingles")
    prints = fingerprint(occurrences(inside, KEY), KEY)

    # multi-index search among the items of the window's size
    radius = radius_for(similarity)
    item_sh = written(items.select("no", "size", F.explode_outer("sh").alias("h")).groupBy("no", "size", "h").agg(F.count(F.lit(1)).alias("c")), "item-shingles")
    item_prints = written(fingerprint(occurrences(item_sh, ["no", "size"]), ["no", "size"]).withColumnsRenamed({"m": "item_m", "print": "item_print"}), "item-prints")
    near = item_prints.select("no", "size", "item_m", "item_print", F.explode(block_values("item_print")).alias("b"))
    near = near.select("no", "size", "item_m", "item_print", "b.block", F.explode(F.array(*(F.col("b.value").bitwiseXOR(F.lit(c)) for c in changes(radius)))).alias("value"))
    near = small(written(near, "item-blocks"))
    probes = prints.select(*KEY, "m", "print", F.explode(block_values("print")).alias("b")).select(*KEY, "m", "print", "b.block", "b.value")
    pairs = probes.join(near, ["size", "block", "value"])
    bits = F.bit_count(F.col("print").bitwiseXOR(F.col("item_print")))
    pairs = pairs.withColumn("bits", bits).where(F.col("bits") <= radius).select(*KEY, "m", "no", "item_m", "bits").distinct()
    pairs = written(pairs, "near")

    # exact similarity of what was found
    window_counts = inside.withColumnsRenamed({k: f"own_{k}" for k in KEY})
    item_counts = small(item_sh.select("no", "h", F.col("c").alias("d")))
    same = F.lit(True)
    for k in KEY:
        same &= F.col(k).eqNullSafe(F.col(f"own_{k}"))
    shared = pairs.join(window_counts, same).join(item_counts, ["no", "h"])
    scored = shared.groupBy(*KEY, "no", "m", "item_m", "bits").agg(F.sum(F.least("c", "d")).alias("both"))
    scored = scored.withColumn("similarity", F.col("both") / (F.col("m") + F.col("item_m") - F.col("both"))).where(F.col("similarity") >= similarity)
    scored = scored.join(small(written(items.select("no", "item"), "item-ids")), "no")
    best = scored.groupBy("id", "t", "item").agg(F.max_by(F.struct("similarity", "start", "size", "bits"), F.struct("similarity", -F.col("start"), -F.col("bits"))).alias("best"))
    return best.select(F.col("id").alias(id_col), F.col("item").alias(item_col), "best.similarity", F.col("best.start").alias("start_word"),
                       (F.col("best.size") + WORDS - 1).alias("n_words"), F.col("best.bits").cast("int").alias("bits"), F.col("t").alias("text_hash"))
