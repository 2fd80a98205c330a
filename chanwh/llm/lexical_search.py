"""Ranked lexical search: hashed max-sketches give upper bounds, exact scores follow until a threshold.

1. One pass over the documents counts them, their terms, and the documents of each query term.
2. In a second pass each document is folded into a *sketch*: its terms are hashed to ``width`` coordinates, and
   a coordinate holds the largest impact (the part of a score that does not depend on the query) of
   the terms that meet there. A query's bound is the weighted sum of its terms' coordinates; since a
   maximum is at least each of its parts, no score is above its bound. The bounds of a batch of documents
   for all queries of a block are one matrix product.
3. For each query a task goes through the batch by descending bound and scores documents exactly, from
   their own term counts, until the bound falls under the score of the task's k-th best so far. What
   ties with it is scored too. The best of all tasks are ranked by Spark.

Queries are taken in blocks whose number, bytes of text and weights are bounded; each block is held
against all documents.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chanwh.llm.shared import UPPER, text_or_empty, written

#: Coordinates of a sketch.
WIDTH = 8192
#: Queries of a block, and bytes of their texts (one longer query is a block by itself).
BLOCK_ITEMS, BLOCK_BYTES = 1024, 8 << 20
#: Documents of a batch, and distinct terms they may have before the batch is closed.
BATCH_ROWS, BATCH_TERMS = 256, 200_000
#: The matrix product runs in single precision; its result is raised by more than its error.
MARGIN = 1.001

#: Digits and a-z stay, A-Z become a-z, other ASCII characters separate; bytes of all other characters stay.
FOLD = bytes(b + 32 if chr(b) in UPPER else b if b >= 0x80 or chr(b).isalnum() else 32 for b in range(256))


def terms_of(text: bytes) -> list[bytes]:
    """Maximal runs of ASCII letters and digits and of characters that are not ASCII, A-Z lower-cased."""
    return text.translate(FOLD).split()


def weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


def length_part(n: int, documents: int, length: int) -> int:
    """m of a document of ``n`` terms: 50 and half its length in hundredths of the average."""
    return 100 - 50 + (50 * n * documents) // length


def impact(tf: int, m: int) -> int:
    return (1_000_000_000 * tf) // (1000 * tf + 20 * m)


@dataclass
class Block:
    """Queries with the weights of their terms, and the corpus figures that scores need."""

    weights: list[dict[bytes, int]]
    documents: int
    length: int
    width: int

    def matrix(self) -> np.ndarray:
        """Weights by coordinate and query; terms of a query that meet at a coordinate add up."""
        out = np.zeros((self.width, len(self.weights)), np.float64)
        for q, own in enumerate(self.weights):
            np.add.at(out[:, q], coordinates(list(own), self.width), np.fromiter(own.values(), np.float64, len(own)))
        return out.astype(np.float32)


def coordinates(terms: list[bytes], width: int) -> np.ndarray:
    digest = xxhash.xxh3_64_intdigest
    return np.fromiter((digest(t) % width for t in terms), np.int64, len(terms))


def sketches(counts: list[Counter], m: list[int], width: int) -> np.ndarray:
    """A row of coordinatewise maxima for each document; impacts are below 2^24, so single precision is exact."""
    doc = np.repeat(np.arange(len(counts)), [len(c) for c in counts])
    tf = np.fromiter((n for c in counts for n in c.values()), np.int64, len(doc))
    folded = np.zeros((len(counts), width), np.float32)
    np.maximum.at(folded, (doc, coordinates([t for c in counts for t in c], width)), (1_000_000_000 * tf // (1000 * tf + 20 * np.array(m, np.int64)[doc])).astype(np.float32))
    return folded


class Best:
    """The ``most`` best documents of each query that a task has seen."""

    def __init__(self, block: Block, most: int):
        self.block, self.most, self.matrix = block, most, block.matrix()
        self.heaps: list[list[tuple]] = [[] for _ in block.weights]
        self.least = np.ones(len(block.weights))
        self.scored = 0

    def score(self, q: int, counts: Counter, m: int) -> int:
        return sum(w * impact(tf, m) for t, w in self.block.weights[q].items() if (tf := counts.get(t)))

    def add(self, ids: list, counts: list[Counter]) -> None:
        m = [length_part(c.total(), self.block.documents, self.block.length) for c in counts]
        bounds = (sketches(counts, m, self.block.width) @ self.matrix).astype(np.float64) * MARGIN
        for q in np.flatnonzero((bounds >= self.least).any(0)):
            heap, column = self.heaps[q], bounds[:, q]
            near = np.flatnonzero(column >= self.least[q])
            for d in near[np.argsort(-column[near], kind="stable")]:
                if column[d] < self.least[q]:
                    break
                self.scored += 1
                if (s := self.score(q, counts[d], m[d])) > 0:
                    # of equal scores the smaller id is better, null is last
                    entry = (s, -(1 << 64) if ids[d] is None else -ids[d], self.scored, ids[d])
                    if len(heap) < self.most:
                        heapq.heappush(heap, entry)
                    else:
                        heapq.heappushpop(heap, entry)
                    if len(heap) == self.most:
                        self.least[q] = max(1, heap[0][0])


def batches_of(batches: Iterator[pa.RecordBatch], rows: int = BATCH_ROWS) -> Iterator[tuple[list, list[Counter]]]:
    """Ids and term counts of documents with terms, some at a time; a text is held alone."""
    ids, counts, held = [], [], 0
    for batch in batches:
        for i, text in zip(batch.column("id").to_pylist(), batch.column("text")):
            if own := Counter(terms_of(text.as_py())):
                ids.append(i)
                counts.append(own)
                held += len(own)
            if len(ids) >= rows or held >= BATCH_TERMS:
                yield ids, counts
                ids, counts, held = [], [], 0
    if ids:
        yield ids, counts


def corpus_figures(rows: DataFrame, vocabulary: set[bytes]) -> tuple[int, int, dict[bytes, int]]:
    """Documents with terms, all their terms, and the documents of each term of ``vocabulary``."""
    spread = rows.sparkSession.sparkContext.broadcast(vocabulary)  # the terms of one block

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, df, documents, length = spread.value, Counter(), 0, 0
        for _, counts in batches_of(batches):
            for c in counts:
                documents, length = documents + 1, length + c.total()
                df.update(wanted & c.keys())
        yield pa.RecordBatch.from_pydict({"term": pa.array([None, *df], pa.binary()), "documents": pa.array([documents, *df.values()], pa.int64()),
                                          "length": pa.array([length] + [0] * len(df), pa.int64())})

    sums = rows.mapInArrow(counted, "term binary, documents long, length long").groupBy("term").agg(F.sum("documents"), F.sum("length")).collect()
    whole = next(((n, length) for term, n, length in sums if term is None), (0, 0))
    return *whole, {bytes(term): n for term, n, _ in sums if term is not None}


def query_blocks(items: DataFrame) -> Iterator[list[tuple]]:
    """(id, terms) of queries with terms, as many at a time as a block may have."""
    block, size = [], 0
    for i, text in items.toLocalIterator():
        if own := set(terms_of(bytes(text))):
            if block and (len(block) >= BLOCK_ITEMS or size + len(text) > BLOCK_BYTES):
                yield block
                block, size = [], 0
            block.append((i, own))
            size += len(text)
    if block:
        yield block


def search_block(rows: DataFrame, queries: list[tuple], number: int, most: int, kind: str, width: int, batch_rows: int) -> DataFrame:
    """The task-wise best documents of a block's queries, ranked over all tasks."""
    documents, length, df = corpus_figures(rows, set().union(*(own for _, own in queries)))
    weights = [{t: weight(documents, df[t]) for t in own if t in df} for _, own in queries]
    spread = rows.sparkSession.sparkContext.broadcast(Block(weights, documents, length, width))

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(spread.value, most)
        for ids, counts in batches_of(batches, batch_rows):
            best.add(ids, counts)
        found = [(q, i, s) for q, heap in enumerate(best.heaps) for s, *_, i in heap]
        for k in range(0, len(found), 10_000):
            q, doc, score = zip(*found[k : k + 10_000])
            yield pa.RecordBatch.from_pydict({"q": pa.array(q, pa.int32()), "id": pa.array(doc, pa.int64()), "score": pa.array(score, pa.int64())})

    found = rows.mapInArrow(searched, "q int, id long, score long")
    ranked = Window.partitionBy("q").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    found = found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= most)
    named = rows.sparkSession.createDataFrame([(q, i) for q, (i, _) in enumerate(queries)], f"q int, item {kind}")
    return written(found.join(F.broadcast(named), "q").select("item", "rank", "id", "score"), f"search-{number}")


def search(docs: DataFrame, items: DataFrame, most: int = 50, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", query_col: str = "text", width: int = WIDTH, batch_rows: int = BATCH_ROWS) -> DataFrame:
    """The ``most`` best documents for each row of ``items``: item, ``rank`` (from 1), id, ``score`` (above 0).

    Terms are runs of ASCII letters, digits and characters that are not ASCII, with A-Z lower-cased. With N
    documents that have terms, L terms in them, n terms in a document, df documents of a term and tf
    occurrences in a document: w = floor(1000 ln((2N + 2) / (2 df + 1))), m = 50 + 50 n N div L, and a score is
    the sum of w * (10^9 tf div (1000 tf + 20 m)) over the query's distinct terms. Equal scores go by
    ascending id (an integer), null ids last.

    Null and empty texts have no terms: such documents are never found, such items get no rows. Every row
    is a document, every item row a query, repeated ones too. No rows on either side: an empty result.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_or_empty(text_col).cast("binary").alias("text"))
    queries = items.select(F.col(item_col).alias("item"), text_or_empty(query_col).cast("binary").alias("text"))
    kind = queries.schema["item"].dataType.simpleString()
    blocks = [search_block(rows, block, number, most, kind, width, batch_rows) for number, block in enumerate(query_blocks(queries))]
    found = reduce(DataFrame.unionByName, blocks) if blocks else rows.sparkSession.createDataFrame([], f"item {kind}, rank int, id long, score long")
    return found.select(F.col("item").alias(item_col), "rank", F.col("id").cast(docs.schema[id_col].dataType).alias(id_col), "score")
