"""Toxicity by the nearest labelled examples: exact TF-IDF cosine over a block-max inverted index.

1. A bounded sample of labelled rows (``EXAMPLES`` of each class, by a hash of the id) gives the
   features: words, and beginnings of words (which catch inflected forms), whose frequency in toxic
   examples is significantly higher by the log-likelihood ratio; the best ``FEATURES`` are taken.
2. Every document is read once; only its counts of those features are kept. Document frequencies,
   hence the IDF weights, are counted over all documents.
3. The examples' vectors form an inverted index in blocks; each feature has its largest weight in
   each block. The sum of a query's weights times those maxima bounds any similarity in a block, so
   blocks are visited by falling bound until no other can hold one of the k nearest: the result is
   the exact one.
4. The neighbours vote with their squared similarity, each class weighted by how many labelled rows
   an example stands for. Votes become probabilities by isotonic regression on the examples, each
   judged without those of its own text. A document with no feature has no neighbour and gets the share of toxic
   rows among such examples.

The index is bounded by the two parameters, whatever the input's size; it is broadcast.
"""

from __future__ import annotations

import pickle
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chanwh.llm.shared import text_or_empty, written

#: Bounds of what is fitted on labelled rows: examples of each class, features, neighbours.
EXAMPLES, FEATURES, NEIGHBOURS = 2500, 4096, 15
#: A feature must occur in so many examples, with this log-likelihood ratio: by chance one in about two
#: million has it, and some hundred thousand are tried.
LEAST_EXAMPLES, LEAST_RATIO = 4, 25.0
BEGINNINGS = (4, 5, 6)
BLOCK = 64
#: Words whose features a Python worker remembers.
REMEMBERED = 100_000
TOKEN = re.compile(r"[^\W\d_]+")


def held_out(id_col: str) -> Column:
    """Rows that nothing is learnt from: crc32 of the id as text is divisible by 5."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def features_of(word: str) -> list[str]:
    return [word, *(f"{word[:n]}*" for n in BEGINNINGS if len(word) >= n)]


class Known(dict):
    """Word -> numbers of its selected features; remembers a bounded number of words."""

    def __init__(self, numbers: dict[str, int]):
        super().__init__()
        self.numbers = numbers

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) > REMEMBERED:
            self.clear()
        self[word] = found = tuple(self.numbers[f] for f in features_of(word) if f in self.numbers)
        return found


def count_examples(texts: DataFrame) -> DataFrame:
    """(feature, toxic, clean): in how many examples of either class each feature occurs."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            toxic: Counter = Counter()
            clean: Counter = Counter()
            for text, label in zip(batch["text"], batch["label"]):
                (toxic if label else clean).update({f for w in set(TOKEN.findall(text.lower())) for f in features_of(w)})
            names = list(toxic.keys() | clean.keys())
            yield pd.DataFrame({"feature": names, "toxic": [toxic[f] for f in names], "clean": [clean[f] for f in names]})

    counted = texts.select("text", "label").mapInPandas(count, "feature string, toxic bigint, clean bigint")
    return counted.groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def select_features(counted: DataFrame, toxic: int, clean: int, most: int) -> list[str]:
    """The ``most`` features by log-likelihood ratio among those more frequent in toxic examples."""
    n = toxic + clean
    term = lambda seen, expected: F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)
    a, b = F.col("toxic").cast("double"), F.col("clean").cast("double")
    share = (a + b) / n
    ratio = 2 * (term(a, share * toxic) + term(b, share * clean) + term(toxic - a, (1 - share) * toxic) + term(clean - b, (1 - share) * clean))
    chosen = (counted.where((a + b >= LEAST_EXAMPLES) & (a * clean > b * toxic)).withColumn("ratio", ratio)
              .where(F.col("ratio") >= LEAST_RATIO).orderBy(F.desc("ratio"), "feature").limit(most))
    return [r["feature"] for r in chosen.select("feature").collect()]  # ``most`` rows


def vectors(docs: DataFrame, features: list[str]) -> DataFrame:
    """``terms`` and ``counts``, the selected features of each text and how often it has them, in place
    of the text."""
    spark = docs.sparkSession
    numbers = spark.sparkContext.broadcast({f: k for k, f in enumerate(features)})  # FEATURES entries at most

    @F.arrow_udf("struct<terms: array<int>, counts: array<int>>")
    def read(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = Known(numbers.value)
        for texts in batches:
            terms, counts = [], []
            for text in texts:  # one text at a time is a Python string
                found: Counter = Counter()
                for numbers_of in filter(None, map(known.__getitem__, TOKEN.findall(text.as_py().lower()))):
                    found.update(numbers_of)
                order = sorted(found)
                terms.append(order)
                counts.append([found[t] for t in order])
            kind = pa.list_(pa.int32())
            yield pa.StructArray.from_arrays([pa.array(terms, kind), pa.array(counts, kind)], names=["terms", "counts"])

    return docs.withColumn("v", read("text")).select(*(c for c in docs.columns if c != "text"), "v.terms", "v.counts")


class BlockMaxIndex:
    """Inverted index of unit vectors in blocks of BLOCK examples, with each term's largest weight in each
    block. Examples with like terms are neighbours, so that the maxima are tight."""

    def __init__(self, examples: list[tuple], idf: np.ndarray):
        self.idf = idf
        rows = [(i, label, *self.weigh(t, c)) for i, label, t, c in examples]
        rows.sort(key=lambda r: (sorted(r[2], key=lambda t: -idf[t])[:3], r[0]))
        self.ids, self.texts = [r[0][0] for r in rows], [r[0][1] for r in rows]
        self.labels = np.array([r[1] for r in rows], np.int8)
        self.blocks = -(-len(rows) // BLOCK)
        self.largest = np.zeros((len(idf), self.blocks), np.float32)
        lists: list[list[tuple[int, float]]] = [[] for _ in idf]
        for k, (_, _, terms, weights) in enumerate(rows):
            for t, w in zip(terms, weights):
                lists[t].append((k, w))
                self.largest[t, k // BLOCK] = max(self.largest[t, k // BLOCK], np.nextafter(np.float32(w), np.float32(2)))
        self.places = [np.array([k for k, _ in x], np.int32) for x in lists]
        self.weights = [np.array([w for _, w in x]) for x in lists]
        self.starts = [np.searchsorted(p, np.arange(self.blocks + 1) * BLOCK) for p in self.places]

    def weigh(self, terms, counts) -> tuple[list[int], np.ndarray]:
        terms = list(terms)
        w = (1 + np.log(np.asarray(counts, float))) * self.idf[terms] if terms else np.zeros(0)
        return terms, w / np.sqrt((w * w).sum()) if len(w) else w

    def nearest(self, terms, counts, k: int, but=None) -> list[tuple[int, float]]:
        """The ``k`` examples of the highest cosine (ties: the earlier in the index), without those with the text ``but``."""
        terms, query = self.weigh(terms, counts)
        if not terms:
            return []
        bounds = query @ self.largest[terms] + 1e-6
        best: list[tuple[float, int]] = []  # (-similarity, place)
        for b in np.argsort(-bounds, kind="stable").tolist():
            if bounds[b] <= 2e-6 or (len(best) >= k and bounds[b] < -best[k - 1][0]):
                break
            scores = np.zeros(BLOCK)
            for t, q in zip(terms, query):
                lo, hi = self.starts[t][b], self.starts[t][b + 1]
                if hi > lo:
                    scores[self.places[t][lo:hi] - b * BLOCK] += q * self.weights[t][lo:hi]
            for j in np.flatnonzero(scores).tolist():
                if but is None or self.texts[b * BLOCK + j] != but:
                    best.append((-round(float(scores[j]), 9), b * BLOCK + j))
            best.sort()
            del best[k:]
        return [(place, -s) for s, place in best]


class Judge:
    """Votes of the nearest examples as calibrated scores."""

    def __init__(self, index: BlockMaxIndex, class_weights: tuple[float, float], k: int):
        self.index, self.k = index, k
        self.class_weights = np.array(class_weights)
        self.cache: dict = {}

    def vote(self, terms, counts, but=None) -> tuple[float | None, list[tuple[int, float]]]:
        near = self.index.nearest(terms, counts, self.k, but)
        if not near:
            return None, near
        labels = self.index.labels[[p for p, _ in near]]
        weights = np.array([s * s for _, s in near]) * self.class_weights[labels]
        return float(weights[labels == 1].sum() / weights.sum()), near

    def calibrate(self, examples: list[tuple]) -> None:
        votes, labels, weights, none = [], [], [], np.zeros(2)
        for (_, text), label, terms, counts in examples:
            vote, _ = self.vote(terms, counts, but=text)
            if vote is None:
                none[label] += self.class_weights[label]
            else:
                votes.append(vote)
                labels.append(label)
                weights.append(self.class_weights[label])
        # one more example, as the classes are spread overall, for every region
        n = self.class_weights * np.bincount([e[1] for e in examples], minlength=2) if examples else np.zeros(2)
        prior = n[1] / n.sum() if n.sum() else 0.0
        self.none = float((none[1] + prior) / (none.sum() + 1))
        self.knots, self.values = isotonic(np.array(votes), np.array(labels, float), np.array(weights))

    def score(self, terms, counts, but=None) -> tuple[float, list[int], list[float]]:
        key = (tuple(terms), tuple(counts), but if but in self.known else None)
        if key not in self.cache:
            if len(self.cache) > 10_000:
                self.cache.clear()
            vote, near = self.vote(terms, counts, key[2])
            s = self.none if vote is None else float(np.interp(vote, self.knots, self.values)) if len(self.knots) else vote
            self.cache[key] = min(1.0, max(0.0, s)), [self.index.ids[p] for p, _ in near], [round(x, 6) for _, x in near]
        return self.cache[key]

    @property
    def known(self) -> set:
        if "_known" not in self.__dict__:
            self._known = set(self.index.texts)
        return self._known


def isotonic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots and values of the weighted least-squares rising function (pool adjacent violators)."""
    pools: list[list[float]] = []  # sum of w*y, sum of w, smallest x, largest x
    for v in np.unique(x):
        at = x == v
        pools.append([float((w[at] * y[at]).sum()), float(w[at].sum()), float(v), float(v)])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            last = pools.pop()
            pools[-1] = [pools[-1][0] + last[0], pools[-1][1] + last[1], pools[-1][2], last[3]]
    knots, values = [], []
    for s, total, low, high in pools:
        for v in (low, high) if high > low else (low,):
            knots.append(v)
            values.append(s / total)
    return np.array(knots), np.array(values)


def score_toxicity(docs: DataFrame, labels: DataFrame, examples: int = EXAMPLES, features: int = FEATURES, k: int = NEIGHBOURS,
                   id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """One row per row of ``docs``: id, ``held_out``, ``score``, ``predicted``, ``neighbours`` and
    ``similarities`` (the evidence: ids of the nearest labelled examples and their cosine), and
    ``text_hash`` (xxhash64 of the text: tells rows with the same id apart).

    Only the text enters a score. Null texts are empty; a text without features (an empty one too)
    gets the score of such examples. A label row with a null id or label is ignored; of several
    labels of an id the largest counts. Without labelled rows every score is 0. Rows with equal ids
    are scored one by one, of those of a labelled id one is an example. A document is judged without the
    examples that have its text, so equal texts have equal scores, whatever their ids.
    """
    spark = docs.sparkSession
    known = (labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).where("id is not null and label is not null")
             .where(~held_out("id")).groupBy("id").agg(F.max("label").alias("label")))
    text = text_or_empty(text_col)
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"), F.xxhash64(text).alias("text_hash"))
    sizes = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    take = lambda label: known.where(F.col("label") == label).orderBy(F.xxhash64(F.lit("example"), "id"), "id").limit(examples)
    sample = written(take(1).unionByName(take(0)), "sample")  # 2 x examples ids
    # one row for each id, so that what is collected below is bounded by the sample
    chosen = rows.join(F.broadcast(sample), "id").groupBy("id", "label").agg(F.min_by(F.struct("text", "text_hash"), F.struct("text_hash", "text")).alias("one"))
    chosen = written(chosen.select("id", "label", "one.*"), "example-texts")
    have = {r["label"]: r["count"] for r in chosen.groupBy("label").count().collect()}
    toxic, clean = have.get(1, 0), have.get(0, 0)
    names = select_features(count_examples(chosen), toxic, clean, features) if toxic and clean else []

    counted = written(vectors(rows, names), "vectors")
    n = counted.count()
    seen = {r["t"]: r["count"] for r in counted.select(F.explode("terms").alias("t")).groupBy("t").count().collect()}  # FEATURES rows at most
    idf = np.array([np.log((n + 1) / (seen.get(t, 0) + 1)) + 1 for t in range(len(names))])
    fitted = [((r["id"], r["text_hash"]), r["label"], r["terms"], r["counts"]) for r in vectors(chosen.select("id", "label", "text_hash", "text"), names).collect()]
    judge = Judge(BlockMaxIndex(fitted, idf), (sizes.get(0, 0) / clean if clean else 0.0, sizes.get(1, 0) / toxic if toxic else 0.0), k)
    judge.calibrate(fitted)
    # bounded by examples, features and the examples' features; bytes, so that classes travel along
    shared = spark.sparkContext.broadcast(cloudpickle.dumps(judge))
    kind = counted.schema["id"].dataType.simpleString()

    @F.pandas_udf(f"score double, neighbours array<{kind}>, similarities array<double>")
    def judged(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        own = pickle.loads(shared.value)
        for texts, terms, counts in batches:
            yield pd.DataFrame([own.score(t, c, h) for h, t, c in zip(texts, terms, counts)], columns=["score", "neighbours", "similarities"])

    out = counted.withColumn("j", judged("text_hash", "terms", "counts"))
    return out.select(F.col("id").alias(id_col), held_out("id").alias("held_out"), "j.score", (F.col("j.score") >= 0.5).cast("int").alias("predicted"),
                      "j.neighbours", "j.similarities", "text_hash")

