"""How far the term distributions of a language's sources are apart, by a recount over perfect hashes.

1. First pass: in how many documents of its language each term occurs, summed in the task before it is
   shuffled; terms under the least frequency go. The filter is exact.
2. The kept terms of a language are dealt to *shards* of about ``SHARD_KEYS`` terms by hash. Each shard
   gets a minimal perfect hash: levels of bits at which keys that meet no other key keep their place and
   the rest go one level down; the rank of a key's bit is its slot. Terms are stored in slot order, so
   a term that was not kept is told apart by comparing its bytes with the key of its slot.
3. Second pass: each task counts terms by group, finds their slots and emits (group, shard, slot, count);
   shards are broadcast only while their measured bytes stay under a bound, otherwise the counts are
   shuffled to the shards and find their slots there.
4. Per shard the counts of all groups become a dense matrix, a row for each source and a column for each
   slot, in which all divergences are vector operations. Sources come in tiles of ``TILE``, so a matrix
   has at most about 2 x ``TILE`` x ``SHARD_KEYS`` slots, whatever the number of sources.

All numbers are integers, so results do not depend on how rows are partitioned.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chanwh.llm.shared import UPPER, small, text_or_empty, written

UNIT = 1_000_000_000
#: Keys of a shard on average, bits of a level for each key that reaches it, and levels; keys that share
#: all 64 hash bits reach none of them and are kept in a list.
SHARD_KEYS, GAMMA, LEVELS = 4096, 2, 24
#: Sources of a tile.
TILE = 32
#: Entries that a task counts before it hands them on, and bytes of perfect hashes and keys that are broadcast.
HELD, BROADCAST_BYTES = 500_000, 64 << 20
#: Spark's xxhash64 of one value.
SEED = 42
#: A slot and its shard in one long.
SLOT_BITS = 20

#: A-Z become a-z; other ASCII characters separate; bytes of all other characters stay.
FOLD = bytes(b if b >= 0x80 or chr(b) in UPPER.lower() else b + 32 if chr(b) in UPPER else 32 for b in range(256))


def terms_of(text: bytes) -> list[bytes]:
    """Maximal runs of characters that are ASCII letters or not ASCII, with A-Z lower-cased."""
    return text.translate(FOLD).split()


def hashes(terms: list[bytes]) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(t, SEED) for t in terms), np.uint64, len(terms))


def shard_of(h: Column, shards: Column) -> Column:
    return F.shiftrightunsigned(h, 32) % shards


def mixed(h: np.ndarray, level: int) -> np.ndarray:
    """Another hash of the same key for each level (the finalizer of SplitMix64)."""
    x = h + np.uint64((level + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def pack_keys(keys: list[bytes]) -> tuple[bytes, bytes]:
    return b"".join(keys), np.cumsum([len(k) for k in keys], dtype=np.int32).tobytes()


def unpack_keys(blob: bytes, ends: bytes) -> pa.Array:
    stops = np.concatenate([np.zeros(1, np.int32), np.frombuffer(ends, np.int32)])
    return pa.Array.from_buffers(pa.binary(), len(stops) - 1, [None, pa.py_buffer(stops.tobytes()), pa.py_buffer(blob)])


def perfect_hash(keys: list[bytes]) -> dict:
    """The minimal perfect hash of a shard: bits of each level, their words, and the keys in slot order."""
    h, left = hashes(keys), np.arange(len(keys))
    sizes, words, order = [], [], []
    for level in range(LEVELS):
        if not len(left):
            break
        size = max(64, -(-GAMMA * len(left) // 64) * 64)
        at = (mixed(h[left], level) % np.uint64(size)).astype(np.int64)
        alone = np.bincount(at, minlength=size)[at] == 1
        bits = np.zeros(size, np.uint8)
        bits[at[alone]] = 1
        words.append(np.packbits(bits, bitorder="little").view(np.uint64))
        order.append(left[alone][np.argsort(at[alone])])
        sizes.append(size)
        left = left[~alone]
    order = np.concatenate([*order, left])
    blob, ends = pack_keys([keys[i] for i in order])
    return {"n": len(keys), "loose": len(left), "sizes": np.array(sizes, np.int64).tobytes(),
            "words": np.concatenate(words).tobytes(), "keys": blob, "ends": ends}


SHARD = "lang string, shards long, shard long, n int, loose int, sizes binary, words binary, keys binary, ends binary"


class PerfectHashes:
    """All shards of one language: term -> (shard, slot), or none if the term is not a key."""

    def __init__(self, shards: list[dict]):
        self.count = len(shards)
        sizes = [np.frombuffer(s["sizes"], np.int64) for s in shards]
        self.size = np.zeros((self.count, LEVELS), np.int64)
        self.word_at = np.zeros((self.count, LEVELS), np.int64)
        n = np.array([s["n"] for s in shards], np.int64)
        self.base = np.cumsum(n) - n
        first = 0
        for i, s in enumerate(sizes):
            self.size[i, : len(s)] = s
            self.word_at[i, : len(s)] = first + (np.cumsum(s) - s) // 64
            first += int(s.sum()) // 64
        self.words = np.concatenate([np.frombuffer(s["words"], np.uint64) for s in shards])
        ones = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.cumsum(ones) - ones
        self.keys = pa.concat_arrays([unpack_keys(s["keys"], s["ends"]) for s in shards])
        self.loose = {self.keys[int(b + k)].as_py(): int(b + k) for s, b in zip(shards, self.base) for k in range(s["n"] - s["loose"], s["n"])}

    def find(self, terms: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Indexes of the terms that are keys, with their shards and slots."""
        h = hashes(terms)
        shard = ((h >> np.uint64(32)) % np.uint64(self.count)).astype(np.int64)
        place, todo = np.full(len(terms), -1, np.int64), np.arange(len(terms))
        for level in range(LEVELS):
            todo = todo[self.size[shard[todo], level] > 0]
            if not len(todo):
                break
            s = shard[todo]
            at = mixed(h[todo], level) % self.size[s, level].astype(np.uint64)
            word, bit = self.word_at[s, level] + (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
            held = self.words[word]
            hit = (held >> bit) & np.uint64(1) == 1
            rank = self.before[word] + np.bitwise_count(held & ((np.uint64(1) << bit) - np.uint64(1))) - self.before[self.word_at[s, 0]]
            place[todo[hit]] = (self.base[s] + rank)[hit]
            todo = todo[~hit]
        if self.loose:
            for i in np.flatnonzero(place < 0):
                place[i] = self.loose.get(terms[i], -1)
        found = np.flatnonzero(place >= 0)
        stored = self.keys.take(pa.array(place[found]))
        same = pc.equal(stored, pa.array([terms[i] for i in found], pa.binary()))
        found = found[np.asarray(same, bool)] if len(found) else found
        return found, shard[found], place[found] - self.base[shard[found]]


def grouped(batches: Iterator[pa.RecordBatch], names: list[str], once: bool) -> Iterator[dict[tuple, Counter]]:
    """Term counts by the columns ``names``, over as many rows as fit under ``HELD`` entries; ``once``:
    each document counts a term once."""
    counts: dict[tuple, Counter] = {}
    for batch in batches:
        keys = list(zip(*(batch.column(n).to_pylist() for n in names)))
        for key, text in zip(keys, batch.column("text")):
            found = terms_of(text.as_py())
            if found:
                counts.setdefault(key, Counter()).update(set(found) if once else found)
            if sum(map(len, counts.values())) > HELD:
                yield counts
                counts = {}
    yield counts


def in_batches(columns: dict[str, list | np.ndarray | pa.Array], schema: pa.Schema, rows: int = 50_000) -> Iterator[pa.RecordBatch]:
    table = pa.table({f.name: pa.array(columns[f.name], f.type) for f in schema}, schema=schema)
    yield from table.to_batches(max_chunksize=rows)


def document_frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("lang", pa.string()), ("term", pa.binary()), ("df", pa.int64())])
    for counts in grouped(batches, ["lang"], once=True):
        for (lang,), c in counts.items():
            yield from in_batches({"lang": [lang] * len(c), "term": list(c), "df": list(c.values())}, schema)


def source_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.binary()), ("n", pa.int64())])
    for counts in grouped(batches, ["lang", "source"], once=False):
        for (lang, source), c in counts.items():
            yield from in_batches({"lang": [lang] * len(c), "source": [source] * len(c), "term": list(c), "n": list(c.values())}, schema)


CELL = pa.schema([("lang", pa.string()), ("source", pa.string()), ("cell", pa.int64()), ("n", pa.int64())])


def cells_of(lang: str, counts: dict[str, dict[bytes, int]], hashed: PerfectHashes) -> Iterator[dict]:
    """The cells of a language's counts by source; a term of several sources is looked up once."""
    numbers: dict[bytes, int] = {}
    own = [np.fromiter((numbers.setdefault(t, len(numbers)) for t in c), np.int64, len(c)) for c in counts.values()]
    found, shard, slot = hashed.find(list(numbers))
    cells = np.full(len(numbers), -1, np.int64)
    cells[found] = (shard << SLOT_BITS) | slot
    for (source, c), at in zip(counts.items(), own):
        kept = cells[at] >= 0
        rows = int(kept.sum())
        yield {"lang": [lang] * rows, "source": [source] * rows, "cell": cells[at][kept], "n": np.fromiter(c.values(), np.int64, len(c))[kept]}


def share(count: np.ndarray, total: int) -> np.ndarray:
    """1 + floor(UNIT * count / total), exactly: long division by thousands."""
    q, r = np.zeros_like(count), count.copy()
    for _ in range(3):
        r *= 1000
        q = q * 1000 + r // total
        r %= total
    return q + 1


def shard_divergences(key: tuple, cells: pd.DataFrame, shard: pd.DataFrame, most: int) -> pd.DataFrame:
    """Divergences of the sources of two tiles (or of one) over the terms of a shard: for pairs their sum,
    for terms the ``most`` highest of each source."""
    lang, _, a, b = key
    s = shard.iloc[0]
    width, kinds = int(s["n"]), int(s["kinds"])
    sides = [("a", list(s["names_a"]), np.array(s["totals_a"], np.int64))]
    if a != b:
        sides.append(("b", list(s["names_b"]), np.array(s["totals_b"], np.int64)))
    names = [x for _, own, _ in sides for x in own]
    totals = np.concatenate([t for *_, t in sides])
    count = np.zeros((len(names) + 1, width), np.int64)
    # idx counts from the language's first source; the last row is the language itself
    idx = cells["idx"].to_numpy(np.int64)
    row = np.where(idx < 0, len(names), np.where(idx // TILE == a, idx - a * TILE, idx - b * TILE + len(sides[0][1])))
    np.add.at(count, (row, cells["slot"].to_numpy(np.int64)), cells["n"].to_numpy(np.int64))
    p = np.stack([share(count[i] + 1, int(t) + kinds) for i, t in enumerate([*totals, int(s["total"])])])

    out = {"source": [], "part": [], "item": [], "value": []}

    def add(source, part, items, values):
        out["source"] += [source] * len(items) if isinstance(source, str) else source
        out["part"] += [part] * len(items)
        out["item"] += items
        out["value"] += values

    split = len(sides[0][1])
    for j, item in enumerate(names):
        others = [i for i in range(len(names)) if i != j and (a == b or (i < split) != (j < split))]
        if others:
            gap = p[others] - p[j]
            add([names[i] for i in others], "pair", [item] * len(others), (gap * gap // p[j]).sum(1).tolist())
    if a == b:
        keys = unpack_keys(s["keys"], s["ends"]).to_pylist()
        alphabetic = np.empty(width, np.int64)
        alphabetic[sorted(range(width), key=keys.__getitem__)] = np.arange(width)
        q = p[len(names)]
        for i, source in enumerate(names):
            at = np.flatnonzero((count[i] > 0) & (p[i] > q))
            value = (p[i][at] - q[at]) ** 2 // q[at]
            top = np.lexsort((alphabetic[at], -value))[:most]
            add(source, "term", [keys[k].decode("utf-8", "replace") for k in at[top]], value[top].tolist())
    return pd.DataFrame({"lang": lang, **out}).astype({"lang": object, "source": object, "part": object, "item": object, "value": "int64"})


def kept_terms(rows: DataFrame, least_documents: int) -> DataFrame:
    """(lang, term) of terms in at least so many documents of the language."""
    partial = rows.select("lang", "text").mapInArrow(document_frequencies, "lang string, term binary, df long")
    return partial.groupBy("lang", "term").agg(F.sum("df").alias("df")).where(F.col("df") >= least_documents).select("lang", "term")


def build_shards(kept: DataFrame) -> DataFrame:
    """The perfect hashes of all languages' kept terms, a row for each shard."""
    kinds = kept.groupBy("lang").agg(F.ceil(F.count(F.lit(1)) / SHARD_KEYS).alias("shards"))
    dealt = kept.join(kinds, "lang").select("lang", "shards", shard_of(F.xxhash64("term"), F.col("shards")).alias("shard"), "term")
    built = lambda key, g: pd.DataFrame([{"lang": key[0], "shards": key[1], "shard": key[2], **perfect_hash(sorted(g["term"]))}])
    return dealt.groupBy("lang", "shards", "shard").applyInPandas(built, SHARD)


def count_cells(rows: DataFrame, shards: DataFrame, broadcast_bytes: int) -> DataFrame:
    """Occurrences of kept terms: (lang, source, cell, n), where a cell is a shard and a slot."""
    size = shards.agg(F.sum(F.octet_length("words") + F.octet_length("keys") + F.octet_length("ends") + 300)).first()[0] or 0
    if size <= broadcast_bytes:
        held: dict[str, list] = {}
        # a bounded number of bytes, just measured
        for s in shards.orderBy("lang", "shard").collect():
            held.setdefault(s["lang"], []).append({k: bytes(v) if isinstance(v, bytearray) else v for k, v in s.asDict().items()})
        spread = rows.sparkSession.sparkContext.broadcast(fill_gaps(held))

        def recount(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            hashed = {lang: PerfectHashes(s) for lang, s in spread.value.items()}
            for counts in grouped(batches, ["lang", "source"], once=False):
                for lang in {x for x, _ in counts} & hashed.keys():
                    for cells in cells_of(lang, {s: c for (x, s), c in counts.items() if x == lang}, hashed[lang]):
                        yield from in_batches(cells, CELL)

        cells = rows.mapInArrow(recount, "lang string, source string, cell long, n long")
    else:
        counts = rows.mapInArrow(source_terms, "lang string, source string, term binary, n long").groupBy("lang", "source", "term").agg(F.sum("n").alias("n"))
        number = shards.groupBy("lang").agg(F.max("shards").alias("number"))
        counts = counts.join(small(number), "lang").select("lang", "source", "term", "n", shard_of(F.xxhash64("term"), F.col("number")).alias("shard"))

        def recount_shard(key: tuple, terms: pd.DataFrame, shard: pd.DataFrame) -> pd.DataFrame:
            out = [pd.DataFrame({c: [] for c in CELL.names})]
            if len(shard):
                hashed = PerfectHashes([shard.iloc[0].to_dict()])
                own = {source: dict(zip(g["term"], g["n"])) for source, g in terms.groupby("source")}
                out += [pd.DataFrame(c).assign(cell=lambda d: d["cell"] | (int(key[1]) << SLOT_BITS)) for c in cells_of(key[0], own, hashed)]
            return pd.concat(out).astype({"lang": object, "source": object, "cell": "int64", "n": "int64"})

        cells = counts.groupBy("lang", "shard").cogroup(shards.groupBy("lang", "shard")).applyInPandas(recount_shard, "lang string, source string, cell long, n long")
    return cells.groupBy("lang", "source", "cell").agg(F.sum("n").alias("n"))


def fill_gaps(held: dict[str, list[dict]]) -> dict[str, list[dict]]:
    """A shard that got no term stands as an empty one, so that shards can be found by number."""
    empty = {"n": 0, "loose": 0, "sizes": b"", "words": b"", "keys": b"", "ends": b""}
    out = {}
    for lang, shards in held.items():
        by = {s["shard"]: s for s in shards}
        out[lang] = [by.get(i, empty) for i in range(shards[0]["shards"])]
    return out


def audit_sources(docs: DataFrame, least_documents: int = 3, top_terms: int = 200, broadcast_bytes: int = BROADCAST_BYTES,
                  lang_col: str = "lang", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """Divergences between the sources of each language: lang, source, part, item, value, rank.

    A language keeps the V terms of at least ``least_documents`` of its documents. A group with N
    occurrences of them, ``count`` of a term, gives it p = 1 + floor(10^9 (count + 1) / (N + V)); q is that
    of another group and f = floor((p - q)^2 / q). Part ``pair``: for each other source of the language the
    sum of f over all kept terms; part ``term``: f against the language as a whole of the terms that the
    source has and prefers, the highest ``top_terms``. Ranks by value, then by item.

    Null text, language and source count as empty strings; a source whose texts have no term takes part
    in pairs; a language with one source has no pairs; without kept terms all pairs have value 0. No rows:
    an empty result. Repeated rows count as often as they occur.
    """
    rows = docs.select(text_or_empty(lang_col).alias("lang"), text_or_empty(source_col).alias("source"), text_or_empty(text_col).cast("binary").alias("text"))
    groups = written(rows.select("lang", "source").groupBy("lang", "source").agg(F.count(F.lit(1)).alias("documents")), "audit-groups")
    kept = written(kept_terms(rows, least_documents), "audit-terms")
    shards = written(build_shards(kept), "audit-shards")
    cells = written(count_cells(rows, shards, broadcast_bytes), "audit-cells")

    kinds = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("kinds"))
    totals = groups.join(cells.groupBy("lang", "source").agg(F.sum("n").alias("total")), ["lang", "source"], "left").join(kinds, "lang", "left")
    totals = totals.select("lang", "source", F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("kinds", F.lit(0)).alias("kinds"),
                           (F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1).alias("idx"))
    totals = written(totals, "audit-totals")
    tiles = totals.withColumn("tile", F.floor(F.col("idx") / TILE)).groupBy("lang", "kinds", "tile")
    tiles = tiles.agg(F.array_sort(F.collect_list(F.struct("idx", "source", "total"))).alias("own"), F.sum("total").alias("sum"))
    langs = tiles.groupBy("lang").agg(F.count(F.lit(1)).alias("tiles"), F.sum("sum").alias("whole"))
    side = lambda x: tiles.where("kinds > 0").select("lang", F.col("tile").alias(x), F.col("own.source").alias(f"names_{x}"), F.col("own.total").alias(f"totals_{x}"), *(["kinds"] if x == "a" else []))
    pairs = side("a").join(side("b"), "lang").where("a <= b").join(langs.select("lang", F.col("whole").alias("total")), "lang")
    right = shards.select("lang", "shard", "n", "keys", "ends").join(pairs, "lang")

    slots = cells.withColumns({"shard": F.shiftright("cell", SLOT_BITS), "slot": F.col("cell").bitwiseAND((1 << SLOT_BITS) - 1)})
    own = slots.join(small(totals.select("lang", "source", "idx")), ["lang", "source"]).select("lang", "shard", "slot", "n", "idx")
    whole = slots.groupBy("lang", "shard", "slot").agg(F.sum("n").alias("n")).withColumn("idx", F.lit(-1))
    per_tile = langs.select("lang", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("j"))
    left = own.unionByName(whole).join(per_tile, "lang").withColumn("tile", F.when(F.col("idx") < 0, F.col("j")).otherwise(F.floor(F.col("idx") / TILE)))
    left = left.select("lang", "shard", F.least("tile", "j").alias("a"), F.greatest("tile", "j").alias("b"), "slot", "idx", "n")
    by = ["lang", "shard", "a", "b"]
    found = left.groupBy(*by).cogroup(right.groupBy(*by)).applyInPandas(
        lambda key, l, r: shard_divergences(key, l, r, top_terms), "lang string, source string, part string, item string, value long")
    found = written(found, "audit-found")

    none = totals.where("kinds = 0").select("lang", "source")
    none = none.join(none.withColumnRenamed("source", "item"), "lang").where("source <> item").select("lang", "source", "item", F.lit(0).cast("long").alias("value"))
    between = found.where("part = 'pair'").groupBy("lang", "source", "item").agg(F.sum("value").alias("value")).unionByName(none)
    ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    between = between.withColumn("rank", F.row_number().over(ranked)).select("lang", "source", F.lit("pair").alias("part"), "item", "value", "rank")
    own_terms = found.where("part = 'term'").withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= top_terms)
    return between.unionByName(own_terms.select("lang", "source", "part", "item", "value", "rank"))
