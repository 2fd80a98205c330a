"""Similarity self-join of texts on five-word shingles (Jaccard), by a MinHash LSH forest.

1. Equal texts are one *text* from here on, with their number of copies.
2. Each text gets ``TREES`` x ``DEPTH`` MinHash values, a tree of the forest for each ``DEPTH`` of them. Texts
   meet where their prefixes agree. The length of the prefixes is shortened from the full depth until the
   chance of a pair at the threshold to meet in some tree, 1 - (1 - s^d)^TREES, reaches the target recall;
   this needs no data. The tries are not built: a node of that depth is the bucket of a hash of its prefix
   (all deeper matches lie inside of it).
3. Pairs in a bucket whose signatures or sizes rule the similarity out (more than six standard
   deviations below the threshold) are dropped; the others join groups. In a bucket of more than
   ``BLOCK`` texts all are put into one group without comparing, which only makes groups larger.
4. Groups are connected components. All pairs inside a group are verified exactly on the shingles, in
   units of two blocks of at most about ``BLOCK`` texts, so a large group is spread over many tasks.
   A unit returns a count for each text and a spanning tree of the links found, never the pairs.
5. Classes are the components of the verified links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chanwh.llm.components import connected_components
from chanwh.llm.shared import small, text_or_empty, written

WORDS = 5
TREES, DEPTH, RECALL = 24, 8, 0.999
#: Texts of a bucket that are compared with each other, and of a block that is verified.
BLOCK = 256
#: Rows of one Python call, and rows of a side that is broadcast (under 300 bytes each).
BUCKET_ROWS, UNIT_ROWS, BROADCAST_ROWS = 20_000, 1_500, 200_000
#: Words hashed at a time: bounds the memory of a very long text.
CHUNK = 20_000

BASE = np.uint64(0x9E3779B97F4A7C15)
_random = np.random.default_rng(20_240_501)
MULTIPLY = (_random.integers(0, 2**31, TREES * DEPTH, dtype=np.uint64) * 2 + 1).astype(np.uint32)
FLIP = _random.integers(0, 2**32, TREES * DEPTH, dtype=np.uint64).astype(np.uint32)


def stop_depth(similarity: float, trees: int = TREES, depth: int = DEPTH, recall: float = RECALL) -> int:
    """The longest prefix at which pairs of this similarity meet with the target recall."""
    while depth > 1 and 1 - (1 - similarity**depth) ** trees < recall:
        depth -= 1
    return depth


class Powers:
    """Powers of BASE and of its inverse modulo 2^64, as many as were needed so far."""

    up = down = np.ones(1, np.uint64)

    @classmethod
    def get(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            size = 1 << n.bit_length()
            inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
            cls.up = np.cumprod(np.concatenate([[np.uint64(1)], np.full(size, BASE)]), dtype=np.uint64)
            cls.down = np.cumprod(np.concatenate([[np.uint64(1)], np.full(size, inverse)]), dtype=np.uint64)
        return cls.up, cls.down


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingle_hashes(text: str) -> np.ndarray:
    """Sorted hashes of the text's distinct shingles: five words in lower case between white space. A
    text of fewer words is one shingle; one without words has none."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    size, found = min(WORDS, len(words)), []
    for first in range(0, len(words) - size + 1, CHUNK):
        part = np.frombuffer(" ".join(words[first:first + CHUNK + size - 1]).encode("utf-8", "surrogatepass"), np.uint8)
        up, down = Powers.get(len(part) + 1)
        spaces = np.flatnonzero(part == 32)
        starts, ends = np.concatenate([[0], spaces + 1]), np.concatenate([spaces, [len(part)]])
        sums = np.concatenate([[np.uint64(0)], np.cumsum((part.astype(np.uint64) + np.uint64(1)) * up[:len(part)], dtype=np.uint64)])
        a, b = starts[:len(starts) - size + 1], ends[size - 1:]
        found.append(mix((sums[b] - sums[a]) * down[a]))
    return np.unique(np.concatenate(found))


def signature(shingles: np.ndarray) -> np.ndarray:
    """MinHash values of a set; of the empty set the largest value everywhere."""
    low = np.full(TREES * DEPTH, 0xFFFFFFFF, np.uint32)
    h = (shingles >> np.uint64(32)).astype(np.uint32)
    for k in range(0, len(h), 2048):
        np.minimum(low, ((h[None, k:k + 2048] ^ FLIP[:, None]) * MULTIPLY[:, None]).min(axis=1), out=low)
    return low


def bucket_keys(low: np.ndarray, depth: int) -> np.ndarray:
    """One key for each tree: a hash of the tree's number and of the first ``depth`` values."""
    prefix = low.reshape(TREES, DEPTH)[:, :depth].astype(np.uint64)
    key = np.arange(1, TREES + 1, dtype=np.uint64)
    for k in range(depth):
        key = mix(key * BASE + prefix[:, k] + np.uint64(1))
    return key.view(np.int64)


def signatures(rows: DataFrame, depth: int) -> DataFrame:
    """Each row's number of shingles, a byte of each MinHash value, and its bucket in each tree (none
    for a text without words)."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, low_bytes, keys = [], [], []
            for text in batch.column("text"):  # one text at a time is a Python string
                shingles = shingle_hashes(text.as_py())
                low = signature(shingles)
                n.append(len(shingles))
                low_bytes.append((low & np.uint32(255)).astype(np.uint8).tobytes())
                keys.append(bucket_keys(low, depth) if len(shingles) else [])
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("digest"), pa.array(n, pa.int32()), pa.array(low_bytes, pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
                names=["id", "digest", "n", "low", "keys"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(sign, f"id {kind}, digest string, n int, low binary, keys array<bigint>")


class Union:
    """Union-find over 0..n-1 whose roots are the smallest members."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = sorted((self.find(x), self.find(y)))
        self.up[y] = x
        return x != y


def bucket_links(similarity: float):
    """Of the buckets of one call: links between texts that may be similar, a spanning forest of each bucket."""
    floor = similarity - 6 * np.sqrt(similarity * (1 - similarity) / (TREES * DEPTH))

    def link(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["key", "row"], kind="stable")
        key, row, n = rows["key"].to_numpy(), rows["row"].to_numpy(), rows["n"].to_numpy(dtype=float)
        low = np.frombuffer(b"".join(rows["low"]), np.uint8).reshape(len(rows), -1)
        cuts = np.concatenate([[0], np.flatnonzero(key[1:] != key[:-1]) + 1, [len(key)]])
        a, b = [], []

        def likely(x: np.ndarray, y: np.ndarray) -> np.ndarray:
            return ((low[x] == low[y]).mean(axis=-1) >= floor) & (np.minimum(n[x], n[y]) >= similarity * np.maximum(n[x], n[y]) - 1e-9)

        sizes = np.diff(cuts)
        twos = cuts[:-1][sizes == 2]
        good = twos[likely(twos, twos + 1)] if len(twos) else twos
        a += row[good].tolist()
        b += row[good + 1].tolist()
        for first, size in zip(cuts[:-1][sizes > 2].tolist(), sizes[sizes > 2].tolist()):
            groups = Union(size)
            for i in range(size - 1):
                rest = np.arange(i + 1, size)
                for j in (rest[likely(np.full(len(rest), first + i), first + rest)]).tolist():
                    if groups.join(i, j):
                        a.append(int(row[first + i]))
                        b.append(int(row[first + j]))
        return pd.DataFrame({"a": np.array(a, np.int64), "b": np.array(b, np.int64)}).drop_duplicates()

    return link


def shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Numbers of common elements of all pairs of sets."""
    m = len(sets)
    out = np.zeros((m, m))
    if m <= 6:
        for i in range(m):
            for j in range(i):
                out[i, j] = out[j, i] = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
        return out
    values, owner = np.concatenate(sets), np.repeat(np.arange(m), [len(s) for s in sets])
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    new = np.concatenate([[True], values[1:] != values[:-1]])
    column = np.cumsum(new) - 1
    often = np.bincount(column)[column] > 1  # what only one set has makes no pair
    column, owner = column[often], owner[often]
    if len(column):
        column = np.cumsum(np.concatenate([[True], column[1:] != column[:-1]])) - 1
        for first in range(0, int(column[-1]) + 1, 4096):
            lo, hi = np.searchsorted(column, [first, first + 4096])
            part = np.zeros((m, min(4096, int(column[-1]) + 1 - first)), np.float32)
            part[owner[lo:hi], column[lo:hi] - first] = 1
            out += part @ part.T
    return out


def verify_units(similarity: float):
    """Exact links in the units of one call: for each text the copies it is linked to, and the first
    text that it is connected to in the unit."""

    def verify(rows: pd.DataFrame) -> pd.DataFrame:
        row, linked, root = [], [], []
        for _, unit in rows.groupby(["component", "left", "right"], sort=False):
            unit = unit.drop_duplicates("row").sort_values("row")
            sets = [shingle_hashes(t) for t in unit["text"]]
            n = np.array([len(s) for s in sets], float)
            both = shared_counts(sets)
            links = (both >= similarity * (n[:, None] + n[None, :] - both) - 1e-9) & (both > 0)
            np.fill_diagonal(links, False)
            block = unit["block"].to_numpy()
            if unit["left"].iloc[0] != unit["right"].iloc[0]:
                links &= block[:, None] != block[None, :]
            copies, ids, groups = unit["copies"].to_numpy(), unit["row"].to_numpy(), Union(len(unit))
            for i in range(len(unit)):
                for j in np.flatnonzero(links[i, :i]).tolist():
                    groups.join(i, j)
            for i in np.flatnonzero(links.any(axis=1)).tolist():
                row.append(int(ids[i]))
                linked.append(int(copies[links[i]].sum()))
                root.append(int(ids[groups.find(i)]))
        return pd.DataFrame({"row": np.array(row, np.int64), "linked": np.array(linked, np.int64), "root": np.array(root, np.int64)})

    return verify


def in_bins(df: DataFrame, key: list[str], rows_of_a_bin: int) -> DataFrame:
    """``df`` with ``bin``, so that a bin holds all rows of a key and about so many rows."""
    bins = max(1, -(-df.count() // rows_of_a_bin))
    return df.withColumn("bin", F.pmod(F.xxhash64(*key), F.lit(bins)))


def similar_texts(docs: DataFrame, similarity: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, ``class_id`` (the smallest id of its class), ``n_links`` (other
    rows of at least this similarity, copies included), ``class_size``, ``kept`` (one row of each
    class), ``text_sha256``.

    Null texts are empty texts; texts without words are similar to their own copies only. A text of
    fewer than five words is one shingle. Null ids are never the smallest of a class that has
    another; rows with equal ids are different rows. No rows: an empty result.
    """
    depth = stop_depth(similarity)
    text = text_or_empty(text_col)
    texts = docs.select(F.col(id_col).alias("id"), F.sha2(text, 256).alias("digest"), text.alias("text"))
    signed = written(signatures(texts, depth).withColumn("row", F.monotonically_increasing_id()), "signatures")

    # one row of each distinct text stands for its copies
    first = F.struct(F.col("id").isNull().alias("no_id"), "id", "row")
    copies = written(signed.groupBy("digest").agg(F.min(first).alias("first"), F.count(F.lit(1)).alias("copies"))
                     .select("digest", "first.id", "first.row", "copies"), "texts")
    members = signed.join(copies.select("row"), "row", "left_semi").select("row", "n", "low", "keys")
    members = written(members, "members")

    # buckets with at least two texts
    placed = members.select("row", F.explode("keys").alias("key"))
    shared = placed.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.min("row").alias("hub")).where("size > 1")
    placed = written(placed.join(written(shared, "buckets").hint("merge"), "key"), "placed")
    stars = placed.where((F.col("size") > BLOCK) & (F.col("row") != F.col("hub"))).select(F.col("row").alias("a"), F.col("hub").alias("b"))
    compared = in_bins(placed.where(F.col("size") <= BLOCK).select("row", "key"), ["key"], BUCKET_ROWS)
    compared = compared.join(members.select("row", "n", "low"), "row")
    pairs = compared.groupBy("bin").applyInPandas(lambda g: bucket_links(similarity)(g), "a bigint, b bigint")
    groups = written(connected_components(stars.unionByName(pairs)), "groups")

    # units of two blocks of a group
    sizes = groups.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    units = groups.withColumnRenamed("node", "row").join(written(sizes, "sizes").hint("merge"), "component")
    units = units.withColumn("block", F.pmod(F.xxhash64("row"), F.col("blocks")).cast("int"))
    units = written(units.join(copies.hint("merge"), "row"), "grouped")
    wanted = units.select("row", "id", "digest", "copies", "component", "block", "blocks")
    wanted = small(wanted, BROADCAST_ROWS)
    found = texts.withColumnRenamed("id", "text_id").join(wanted, (F.col("text_id").eqNullSafe(F.col("id"))) & (texts["digest"] == wanted["digest"]))
    found = found.select("row", "component", "block", "blocks", "copies", "text", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    found = found.withColumns({"left": F.least("block", "other"), "right": F.greatest("block", "other")})
    bins = max(1, -(-(units.agg(F.sum("blocks")).first()[0] or 0) // UNIT_ROWS))
    found = found.withColumn("bin", F.pmod(F.xxhash64("component", "left", "right"), F.lit(bins)))
    verified = found.groupBy("bin").applyInPandas(lambda g: verify_units(similarity)(g), "row bigint, linked bigint, root bigint")
    verified = written(verified, "verified")

    # classes of texts, then of rows
    classes = connected_components(verified.select(F.col("row").alias("a"), F.col("root").alias("b"))).withColumnsRenamed({"node": "row", "component": "class"})
    links = verified.groupBy("row").agg(F.sum("linked").alias("linked"))
    known = copies.join(classes, "row", "left").join(links, "row", "left")
    known = written(known.withColumn("class", F.coalesce("class", "row")), "known")
    totals = known.groupBy("class").agg(F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "row")).alias("first"), F.sum("copies").alias("class_size"))
    totals = written(totals.select("class", F.col("first.id").alias("class_id"), F.col("first.row").alias("class_row"), "class_size"), "classes")
    known = written(known.select("digest", "class", (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).alias("n_links")).join(totals.hint("merge"), "class"), "classed")
    rows = signed.select("id", "row", "digest").join(known.hint("merge"), "digest")
    return rows.select(F.col("id").alias(id_col), "class_id", "n_links", "class_size", (F.col("row") == F.col("class_row")).alias("kept"),
                       F.col("digest").alias("text_sha256"))
