"""Removal of repeated byte strings across documents by a sparse suffix array.

Every byte covered by a ``LENGTH``-byte string that also starts earlier (smaller id, or same
document and earlier start) is removed. Sorting every suffix is not needed: each window of ``LENGTH``
bytes has an *anchor*, the place of the smallest hash of its ``GRAM``-byte strings, and equal windows
have equal anchors. Consecutive windows with the same anchor are a *run*.

1. Equal texts: all but the first are repeats as a whole (if long enough).
2. One pass finds the runs of each text. Runs travel to the bucket of their anchor's string as
   packed arrays; equal runs (same string, same bytes around it) in a batch travel once.
3. In a bucket, an anchor string that occurs once is settled: nothing is repeated. Of equal runs
   all but the earliest are removed as a whole. What is left are runs with the same anchor string
   but different bytes around it, at the ends of repeated passages.
4. Their texts supply the bytes. Suffixes from the anchor and reversed prefixes before it are sorted
   by deep-shallow sorting (see ``suffix_sort``); the common prefixes of neighbours in these two
   suffix arrays tell, for any window of a run, which other windows are equal to it.
5. Each text's removed windows are united, and the rest is hashed.

An anchor string that is frequent within a batch is spread over all buckets by its surroundings,
and one with more than ``HOT`` different surroundings is settled by hashes of its windows, combined
before the shuffle; both give the same result as the sort.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chanwh.llm.ngram_join import BASE, Powers, mix
from chanwh.llm.shared import small, text_or_empty, written
from chanwh.llm.suffix_sort import deep_shallow_sort

LENGTH, GRAM = 100, 32
REACH = LENGTH - GRAM
#: Anchors of a bucket, runs of one sort, surroundings of a string that one sort takes, surroundings
#: within a batch from which a string is spread, and rows (id and hash) of a side that is broadcast.
BUCKET, SORTED, HOT, SPREAD, BROADCAST_ROWS = 250_000, 20_000, 50_000, 64, 400_000
#: Bytes whose hashes are in memory at once.
STEP = 1 << 20
NO_ID = np.iinfo(np.int64).max
RUN = np.dtype([("h", "<i8"), ("c", "<i8"), ("id", "<i8"), ("t", "<i8"), ("at", "<i4"), ("lo", "u1"), ("hi", "u1"), ("kind", "u1")])
#: Kinds: settled where it travels to; spread, so known to have company; a sign that a spread string exists.
PLAIN, SPREADED, SIGN = 0, 1, 2
GONE = np.dtype([("id", "<i8"), ("t", "<i8"), ("first", "<i4"), ("last", "<i4")])


def runs_of(text: bytes) -> tuple[np.ndarray, ...]:
    """(anchor, its hash, first window, last window, hash of the run's bytes) of each run, in order."""
    parts, n = [], len(text)
    for begin in range(0, max(0, n - LENGTH + 1), STEP):
        b = np.frombuffer(text, np.uint8)[begin:begin + STEP + LENGTH - 1]
        up, down = Powers.get(len(b) + 1)
        sums = np.concatenate([[np.uint64(0)], np.cumsum((b.astype(np.uint64) + np.uint64(1)) * up[:len(b)], dtype=np.uint64)])
        least = mix((sums[GRAM:] - sums[:-GRAM]) * down[:len(b) - GRAM + 1])
        hashes, place, span = least, np.arange(len(least), dtype=np.int32), 1
        while span * 2 <= REACH + 1:  # the first smallest of 2, 4, 8 ... hashes
            left = least[:-span] <= least[span:]
            least, place, span = np.where(left, least[:-span], least[span:]), np.where(left, place[:-span], place[span:]), span * 2
        if rest := REACH + 1 - span:
            place = np.where(least[:-rest] <= least[rest:], place[:-rest], place[rest:])
        first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
        last = np.concatenate([first[1:] - 1, [len(place) - 1]])
        at = place[first]
        around = mix((sums[last + LENGTH] - sums[first]) * down[first] + (at - first).astype(np.uint64) * BASE + (last - first).astype(np.uint64))
        parts.append((at + begin, hashes[at], first + begin, last + begin, around))
    return tuple(np.concatenate(x) for x in zip(*parts)) if parts else tuple(np.zeros(0, np.int64) for _ in range(5))


def order_of(runs: np.ndarray) -> np.ndarray:
    """By string, surroundings, then document and place."""
    return np.lexsort((runs["at"], runs["t"], runs["id"], runs["c"], runs["h"]))


def changes(*columns: np.ndarray) -> np.ndarray:
    """Where a sorted array's rows begin a new value."""
    new = np.zeros(len(columns[0]), bool)
    if len(new):
        new[0] = True
        for c in columns:
            new[1:] |= c[1:] != c[:-1]
    return new


def split_equal_runs(runs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the earliest of equal runs, the windows of the others)."""
    runs = runs[order_of(runs)]
    new = changes(runs["h"], runs["c"])
    first = np.flatnonzero(new)[np.cumsum(new) - 1] if len(runs) else np.zeros(0, int)
    same = (runs["id"] == runs["id"][first]) & (runs["t"] == runs["t"][first]) & (runs["at"] == runs["at"][first])
    return runs[new], windows(runs[~same])


def windows(runs: np.ndarray) -> np.ndarray:
    gone = np.zeros(len(runs), GONE)
    gone["id"], gone["t"], gone["first"], gone["last"] = runs["id"], runs["t"], runs["at"] - runs["hi"], runs["at"] - runs["lo"]
    return gone


def pack_runs(buckets: int):
    """Batches of texts to (bucket, runs, gone): packed runs for the bucket, and windows already
    known to be repeats, which only pass through."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(found: list[np.ndarray]) -> pa.RecordBatch:
            runs, gone = split_equal_runs(np.concatenate(found))
            sizes = np.diff(np.append(np.flatnonzero(changes(runs["h"])), len(runs)))
            often = np.repeat(sizes, sizes) >= SPREAD
            signs = runs[often & changes(runs["h"])].copy()
            signs["kind"] = SIGN
            runs["kind"][often] = SPREADED
            runs = np.concatenate([runs, signs])
            to = np.where(runs["kind"] == SPREADED, runs["c"], runs["h"]).view(np.uint64) % np.uint64(buckets)
            by = np.argsort(to, kind="stable")
            runs, to = runs[by], to[by].astype(np.int64)
            through = mix(gone["t"].view(np.uint64)) % np.uint64(buckets)
            by = np.argsort(through, kind="stable")
            gone, through = gone[by], through[by].astype(np.int64)
            targets = np.union1d(to, through)
            parts = [[columns(rows[a:b]) for a, b in zip(np.searchsorted(keys, targets), np.searchsorted(keys, targets, "right"))]
                     for rows, keys in ((runs, to), (gone, through))]
            return pa.RecordBatch.from_arrays([pa.array(targets, pa.int64()), *(pa.array(p, pa.binary()) for p in parts)], names=["bucket", "runs", "gone"])

        found, size = [], 0
        for batch in batches:
            for i, t, text in zip(batch.column("id").to_pylist(), batch.column("t").to_pylist(), batch.column("text")):
                at, h, first, last, around = runs_of(text.as_buffer().to_pybytes())
                runs = np.zeros(len(at), RUN)
                runs["h"], runs["c"], runs["id"], runs["t"], runs["at"] = h.view(np.int64), around.view(np.int64), i, t, at
                runs["lo"], runs["hi"] = at - last, at - first
                found.append(runs)
                size += len(runs)
                if size > BUCKET:
                    yield flush(found)
                    found, size = [], 0
        if size:
            yield flush(found)

    return pack


def columns(rows: np.ndarray) -> bytes:
    """A record array column by column and byte by byte of its numbers: like bytes stand together, which
    the shuffle's compression needs."""
    return b"".join(np.ascontiguousarray(rows[name]).view(np.uint8).reshape(len(rows), rows.dtype[name].itemsize).T.tobytes() for name in rows.dtype.names)


def records(packed: bytes, dtype: np.dtype) -> np.ndarray:
    n, at = len(packed) // dtype.itemsize, 0
    rows = np.zeros(n, dtype)
    for name in dtype.names:
        size = dtype[name].itemsize
        part = np.frombuffer(packed, np.uint8, n * size, at).reshape(size, n).T
        rows[name] = np.ascontiguousarray(part).view(dtype[name]).reshape(n)
        at += n * size
    return rows


SETTLED = "settled boolean, id bigint, t bigint, h bigint, at int, first int, last int"


def settle_bucket(bucket: pd.DataFrame) -> pd.DataFrame:
    """Windows that are gone (settled), and runs whose string has company with other surroundings (open)."""
    runs = np.concatenate([records(x, RUN) for x in bucket["runs"]])
    gone = [records(x, GONE) for x in bucket["gone"]]
    opened = []
    for kind in (SPREADED, PLAIN):
        some = runs[runs["kind"] == kind]
        firsts, more = split_equal_runs(some)
        gone.append(more)
        if kind == PLAIN:
            # the string is open with two surroundings, or if some batch has spread it
            sizes = np.diff(np.append(np.flatnonzero(changes(firsts["h"])), len(firsts)))
            signed = np.isin(firsts["h"], runs["h"][runs["kind"] == SIGN])
            firsts = firsts[(np.repeat(sizes, sizes) > 1) | signed] if len(firsts) else firsts
        opened.append(firsts)
    gone, opened = np.concatenate(gone), np.concatenate(opened)
    spans = windows(opened)
    return pd.DataFrame({
        "settled": np.repeat([True, False], [len(gone), len(opened)]),
        "id": np.concatenate([gone["id"], opened["id"]]), "t": np.concatenate([gone["t"], opened["t"]]),
        "h": np.concatenate([np.zeros(len(gone), np.int64), opened["h"]]), "at": np.concatenate([np.zeros(len(gone), np.int32), opened["at"]]),
        "first": np.concatenate([gone["first"], spans["first"]]), "last": np.concatenate([gone["last"], spans["last"]])})


WINDOWS = "id bigint, t bigint, first int, last int"


def sort_runs(runs: pd.DataFrame) -> pd.DataFrame:
    """The windows of open runs that are repeats, by the suffix arrays to both sides of the anchors."""
    runs = runs.drop_duplicates(["id", "t", "first"]).sort_values(["id", "t", "first"], kind="stable")
    n, at = len(runs), runs["at"].to_numpy()
    first, last = runs["first"].to_numpy(), runs["last"].to_numpy()
    before = np.zeros((n, REACH), np.uint8)
    after = np.zeros((n, LENGTH), np.uint8)
    for k, (text, left) in enumerate(zip(runs["bytes"], (at - first).tolist())):
        row = np.frombuffer(text, np.uint8)
        before[k, :left] = row[:left][::-1]
        right = row[left:left + LENGTH]
        after[k, :len(right)] = right
    (by_left, left), (by_right, right) = deep_shallow_sort(before), deep_shallow_sort(after)
    repeats = np.zeros((n, REACH + 3), bool)
    left_class, right_class = np.empty(n, np.int64), np.empty(n, np.int64)
    for o in range(REACH + 1):  # windows that start o bytes before their anchor
        some = np.flatnonzero((at - last <= o) & (o <= at - first))
        left_class[by_left] = np.cumsum(left < o)
        right_class[by_right] = np.cumsum(right < LENGTH - o)
        _, earliest = np.unique(left_class[some] * (n + 1) + right_class[some], return_index=True)
        later = np.ones(len(some), bool)
        later[earliest] = False
        repeats[some[later], o + 1] = True
    edges = np.diff(repeats.astype(np.int8), axis=1)
    (row, low), (_, high) = np.nonzero(edges == 1), np.nonzero(edges == -1)
    return pd.DataFrame({"id": runs["id"].to_numpy()[row], "t": runs["t"].to_numpy()[row],
                         "first": (at[row] - high + 1).astype(np.int32), "last": (at[row] - low).astype(np.int32)})


def window_hashes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Each window of hot runs: 128 bits of its hash, its document and start."""
    for batch in batches:
        for i, t, first, text in zip(batch["id"], batch["t"], batch["first"], batch["bytes"]):
            hashes = [hashlib.blake2b(text[k:k + LENGTH], digest_size=16).hexdigest() for k in range(len(text) - LENGTH + 1)]
            yield pd.DataFrame({"w": hashes, "id": i, "t": t, "start": np.arange(first, first + len(hashes), dtype=np.int32)})


def remove_windows(text: bytes, spans: list) -> tuple[int, int, str]:
    """(bytes removed, maximal removed runs, hash of the rest)."""
    spans = sorted((s["first"], s["last"] + LENGTH) for s in spans)
    joined: list[list[int]] = []
    for a, b in spans:
        if joined and a <= joined[-1][1]:
            joined[-1][1] = max(joined[-1][1], b)
        else:
            joined.append([a, b])
    rest, at = hashlib.sha256(), 0
    for a, b in joined:
        rest.update(text[at:a])
        at = b
    rest.update(text[at:])
    return sum(b - a for a, b in joined), len(joined), rest.hexdigest()


def own_id(id_col: str) -> Column:
    """Integer ids; null counts as larger than any."""
    return F.coalesce(F.col(id_col).cast("bigint"), F.lit(int(NO_ID)))


def deduplicate_strings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, ``n_bytes``, ``n_removed``, ``n_spans`` (maximal removed runs),
    ``kept_sha256`` (of the remaining bytes).

    Ids are integers; a null id counts as larger than any. Different texts with the same id are
    ordered by a hash of the text; of repeated rows one is the first. Null texts are empty; texts
    under ``LENGTH`` bytes lose nothing. No rows: an empty result.
    """
    text = text_or_empty(text_col)
    all_texts = docs.select(own_id(id_col).alias("id"), text.alias("text")).withColumn("t", F.xxhash64("text"))
    base = written(docs.select(F.col(id_col).alias("given"), own_id(id_col).alias("id"), F.xxhash64(text).alias("t"), F.sha2(text, 256).alias("digest"),
                               F.octet_length(text).cast("bigint").alias("n_bytes"), F.monotonically_increasing_id().alias("row")), "texts")
    firsts = written(base.groupBy("digest").agg(F.min(F.struct("id", "t", "row")).alias("first")).select("digest", "first.id", "first.row")
                     .withColumnsRenamed({"id": "first_id", "row": "first_row"}), "firsts")
    judged = written(base.join(firsts.hint("merge"), "digest"), "judged")
    copies = judged.where(F.col("id") != F.col("first_id")).select("id", "t").distinct()
    copies = small(written(copies, "copies"), BROADCAST_ROWS)
    texts = all_texts.join(copies, ["id", "t"], "left_anti")

    buckets = max(1, -(-(base.agg(F.sum("n_bytes")).first()[0] or 0) // (BUCKET * GRAM)))
    packed = texts.mapInArrow(pack_runs(buckets), "bucket bigint, runs binary, gone binary")
    settled = written(packed.groupBy("bucket").applyInPandas(lambda b: settle_bucket(b), SETTLED), "settled")

    opened = settled.where("not settled").select("h", "id", "t", "at", "first", "last")
    hot = written(opened.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > HOT).select("h"), "hot")
    opened = opened.join(hot.withColumn("hot", F.lit(True)), "h", "left").withColumn("hot", F.coalesce("hot", F.lit(False)))
    lists = written(opened.groupBy("id", "t").agg(F.collect_list(F.struct("h", "at", "first", "last", "hot")).alias("runs")), "open-runs")

    def supply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for i, t, text, runs in zip(batch["id"], batch["t"], batch["text"], batch["runs"]):
                data = text.encode("utf-8", "surrogatepass")
                rows += [(i, t, r["h"], r["at"], r["first"], r["last"], r["hot"], data[r["first"]:r["last"] + LENGTH]) for r in runs]
            yield pd.DataFrame(rows, columns=["id", "t", "h", "at", "first", "last", "hot", "bytes"])

    supplied = texts.join(lists, ["id", "t"]).mapInPandas(supply, "id bigint, t bigint, h bigint, at int, first int, last int, hot boolean, bytes binary")
    supplied = written(supplied, "supplied")
    cool = supplied.where("not hot")
    bins = max(1, -(-cool.count() // SORTED))
    cool = cool.withColumn("bin", F.pmod(F.xxhash64("h"), F.lit(bins))).drop("hot", "h")
    found = cool.groupBy("bin").applyInPandas(lambda g: sort_runs(g), WINDOWS)
    warm = written(supplied.where("hot").mapInPandas(window_hashes, "w string, id bigint, t bigint, start int"), "hot-windows")
    earliest = written(warm.groupBy("w").agg(F.min(F.struct("id", "t", "start")).alias("earliest")), "hot-earliest")
    later = warm.join(earliest.hint("merge"), "w").where(F.struct("id", "t", "start") != F.col("earliest"))
    later = later.select("id", "t", F.col("start").alias("first"), F.col("start").alias("last"))

    gone = settled.where("settled").select("id", "t", "first", "last").unionByName(found).unionByName(later)
    spans = written(gone.groupBy("id", "t").agg(F.collect_list(F.struct("first", "last")).alias("spans")), "spans")

    def rest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            made = [remove_windows(x.encode("utf-8", "surrogatepass"), s) for x, s in zip(batch["text"], batch["spans"])]
            yield pd.DataFrame({"id": batch["id"], "t": batch["t"], "n_removed": [m[0] for m in made], "n_spans": [m[1] for m in made],
                                "kept_sha256": [m[2] for m in made]})

    changed = texts.join(spans, ["id", "t"]).mapInPandas(rest, "id bigint, t bigint, n_removed bigint, n_spans bigint, kept_sha256 string")
    changed = written(changed.dropDuplicates(["id", "t"]), "changed")
    rows = judged.join(changed, ["id", "t"], "left")
    copy = (F.col("row") != F.col("first_row")) & (F.col("n_bytes") >= LENGTH)
    return rows.select(
        F.col("given").alias(id_col), "n_bytes",
        F.when(copy, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("bigint").alias("n_removed"),
        F.when(copy, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("bigint").alias("n_spans"),
        F.when(copy, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept_sha256", "digest")).alias("kept_sha256"))
