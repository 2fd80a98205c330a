import random
import zlib

import numpy as np
import pytest

import corpus_pipeline
from chanwh.llm import decontaminate, queries, toxicity

from llm_cases import LONG, TEXT, documents, messy_rows

SF = "/root/testdata/sf0.01"


def auc(scores, labels):
    ranks = np.argsort(np.argsort(scores, kind="stable"), kind="stable") + 1.0
    for v in np.unique(scores):
        ranks[scores == v] = ranks[scores == v].mean()
    n1 = labels.sum()
    return (ranks[labels == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * (len(labels) - n1))


def test_toxicity_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    labels = dict(queries.table(spark, sf, "labels").select("doc_id", "toxic").collect())
    got = queries.op7_toxicity(spark, sf).toPandas()
    assert len(got) == 10_000
    assert all((zlib.crc32(str(i).encode()) % 5 == 0) == h for i, h in zip(got["doc_id"], got["held_out"]))
    assert got["score"].between(0, 1).all() and ((got["score"] >= 0.5).astype(int) == got["predicted"]).all()
    test = got[got["held_out"] & got["doc_id"].isin(labels)]
    y = test["doc_id"].map(labels).to_numpy()
    assert auc(test["score"].to_numpy(), y) > 0.93
    assert (test["predicted"] == y).mean() > 0.96 and test["predicted"][y == 0].mean() < 0.02
    assert abs(test["score"].mean() - y.mean()) < 0.04  # calibrated


def test_labels_of_held_out_rows_are_not_read(spark):
    docs, labels = documents(spark, SF), queries.table(spark, SF, "labels")
    flipped = labels.withColumn("toxic", toxicity.F.when(toxicity.held_out("doc_id"), 1 - toxicity.F.col("toxic")).otherwise(toxicity.F.col("toxic")))
    score = lambda x: {(r.doc_id, r.score) for r in toxicity.score_toxicity(docs, x).collect()}
    assert score(labels) == score(flipped)


def test_index_is_exact():
    rng = random.Random(6)
    idf = np.array([0.5 + rng.random() * 4 for _ in range(40)])

    def vector():
        terms = sorted(rng.sample(range(40), rng.randrange(0, 6)))
        return terms, [rng.randrange(1, 4) for _ in terms]

    examples = [((k, k % 499), k % 2, *vector()) for k in range(500)]  # the last has the first one's text
    index = toxicity.BlockMaxIndex(examples, idf)
    dense = np.zeros((500, 40))
    for (i, _), _, t, c in examples:
        if t:
            dense[i, t] = index.weigh(t, c)[1]
    for _ in range(200):
        t, c = vector()
        got = index.nearest(t, c, 10, but=0)
        q = np.zeros(40)
        if t:
            q[t] = index.weigh(t, c)[1]
        cosine = dense @ q
        cosine[[0, 499]] = -1
        best = np.sort(cosine[cosine > 0])[::-1][:10]
        assert np.allclose([s for _, s in got], best, atol=1e-6)
        assert all(abs(cosine[index.ids[p]] - s) < 1e-6 for p, s in got)


def test_equal_texts_have_equal_scores_and_repeated_ids_one_example(spark):
    docs = documents(spark, SF).select("doc_id", "text")
    labels = queries.table(spark, SF, "labels")
    again = docs.where("doc_id % 3 = 0").selectExpr("doc_id + 1000000 as doc_id", "text")
    many = docs.where("doc_id < 40").crossJoin(spark.range(30)).drop("id")
    got = toxicity.score_toxicity(docs.unionByName(again).unionByName(many), labels).toPandas()
    assert (got.groupby("text_hash")["score"].nunique() == 1).all()
    chosen = toxicity.score_toxicity(many, labels).toPandas()   # 30 rows of each id: an id is one example
    assert (chosen.groupby("doc_id")["score"].nunique() == 1).all()
    assert max(len(set(n)) - len(n) for n in chosen["neighbours"]) == 0


def test_isotonic():
    knots, values = toxicity.isotonic(np.array([0.1, 0.2, 0.3, 0.3, 0.9]), np.array([0, 1, 0, 0, 1.0]), np.ones(5))
    assert knots.tolist() == [0.1, 0.2, 0.3, 0.9] and np.allclose(values, [0, 1 / 3, 1 / 3, 1])


def test_toxicity_of_messy_rows(spark, messy, nothing):
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, 1), (None, 1), (9, None), (77, 1)], "doc_id bigint, toxic int")
    got = toxicity.score_toxicity(messy, labels).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(r[0]) for r in messy_rows())
    assert all(0 <= r.score <= 1 for r in got)
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    assert {r.score for r in toxicity.score_toxicity(messy, none).collect()} == {0.0}
    assert toxicity.score_toxicity(nothing, labels).count() == 0


def words(text):
    out, word = [], ""
    for c in (text or "").lower() + " ":
        if c.isalpha() or c.isnumeric():
            word += c
        elif word:
            out.append(word)
            word = ""
    return out


def grams(w):
    return [tuple(w[k:k + 5]) for k in range(len(w) - 4)]


def brute_leaks(docs, items, similarity=0.8):
    """(id, item) whose best item-sized window is similar enough, over all windows."""
    from collections import Counter

    found = set()
    for i, t in docs:
        d = grams(words(t))
        for item, text in items:
            want = Counter(grams(words(text)))
            n = sum(want.values())
            if not n or not set(want) & set(d):
                continue
            for a in range(-n + 1, len(d)):
                have = Counter(d[max(a, 0):max(a, 0) + n])
                both = sum((have & want).values())
                if both / (sum(have.values()) + n - both) >= similarity:
                    found.add((i, item))
                    break
    return found


def leaks(docs, items, **more):
    return {(r.doc_id, r.item_id): r for r in decontaminate.find_leaks(docs, items, **more).collect()}


def test_leaks_against_all_windows(spark):
    rng = random.Random(8)
    pool = [f"word{k}" for k in range(400)]
    items = [(k, " ".join(rng.choice(pool) for _ in range(rng.choice([5, 9, 30, 30, 58])))) for k in range(25)] + [(50, "too short"), (51, None), (52, ""), (None, "null id item with enough words in it")]
    items.append((53, items[3][1]))
    docs = []
    for k in range(150):
        w = [rng.choice(pool) for _ in range(rng.randrange(0, 80))]
        passage = items[k % 25][1].split()
        for _ in range(rng.randrange(0, 4)):
            passage[rng.randrange(len(passage))] = "changed" if rng.random() < 0.7 else ""
        at = rng.randrange(len(w) + 1)
        text = " ".join(w[:at] + passage + w[at:])
        docs.append((k, text.upper() if k % 5 == 0 else text.replace(" ", ", ") if k % 7 == 0 else text))
    docs += [(None, "a null id item with enough words in it"), (200, None), (201, items[4][1] + " " + LONG)]
    make = lambda rows, c: spark.createDataFrame([(i, t, 1, 2) for i, t in rows], f"{c} bigint, text string, id int, size int")
    want = brute_leaks(docs, items)
    got = leaks(make(docs, "doc_id"), make(items, "item_id"))
    assert set(got) == want and len(want) > 40
    assert all(0.8 <= r.similarity <= 1 for r in got.values()) and got[None, None].similarity == 1


def test_leaks_with_insertions_and_edited_ends(spark):
    """Windows between two places where the item would start; at the documents' ends, between and alone."""
    rng = random.Random(18)
    pool = [f"word{k}" for k in range(5_000)]
    items = [(k, " ".join(rng.choice(pool) for _ in range(n))) for k, n in enumerate([104, 104, 60, 80, 150, 40])]
    items.append((6, "so it goes on and " * 12))
    docs = []
    for k in range(140):
        p = items[k % 7][1].split()
        a, b, n = (3, 3, 6) if k == 0 else (rng.randrange(5), rng.randrange(5), rng.randrange(1, 8))
        p[:a], p[len(p) - b:] = [f"first{j}" for j in range(a)], [f"last{j}" for j in range(b)]
        mid = len(p) // 2 if k == 0 else rng.randrange(a, len(p) - b)
        p[mid:mid] = [f"new{j}" for j in range(n)]
        around = [[rng.choice(pool) for _ in range(rng.choice([0, 0, 5, 200]))] for _ in range(2)]
        docs.append((k, " ".join(around[0] + p + around[1])))
    swapped = items[0][1].split()
    docs.append((140, " ".join(swapped[52:] + swapped[:52])))
    want = brute_leaks(docs, items)
    got = leaks(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string"))
    assert set(got) == want and (0, 0) in want and 40 < len(want) < 140
    assert abs(got[0, 0].similarity - 90 / 110) < 1e-9


def test_leaks_by_shuffled_joins(spark, monkeypatch):
    docs, items = documents(spark, SF), queries.table(spark, SF, "benchmark")
    broadcast = set(leaks(docs, items))
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", 0)
    assert set(leaks(docs, items)) == broadcast and broadcast
    bench = items.collect()
    assert {(r.doc_id, b.item_id) for r in docs.collect() for b in bench if b.text.lower() in r.text.lower()} == broadcast


def test_multi_index_guarantee():
    rng = random.Random(3)
    radius = decontaminate.radius_for(0.8)
    masks, width = set(decontaminate.changes(radius)), decontaminate.BITS // decontaminate.BLOCKS
    for _ in range(3000):
        flips = sum(1 << b for b in rng.sample(range(64), rng.randrange(radius + 1)))
        assert any((flips >> (k * width)) & ((1 << width) - 1) in masks for k in range(decontaminate.BLOCKS))


def test_fingerprints(spark):
    rng = random.Random(2)
    hashes = [rng.getrandbits(64) - 2**63 for _ in range(31)]
    got = decontaminate.fingerprint(spark.createDataFrame([(1, h) for h in hashes], "g int, h bigint"), ["g"]).first()
    want = sum(1 << b for b in range(64) if sum((h >> b) & 1 for h in hashes) * 2 > 31)
    assert got.m == 31 and got.print % 2**64 == want


def test_leaks_of_nothing(spark, messy, nothing):
    items = spark.createDataFrame([(1, TEXT)], "item_id bigint, text string")
    assert decontaminate.find_leaks(nothing, items).count() == 0
    assert decontaminate.find_leaks(messy, items.limit(0)).count() == 0
    assert {k for k, _ in leaks(messy, items)} == {1, 2, 3, None}


def test_only_the_leaking_rows_go(spark, monkeypatch):
    """Of rows without an id, or with the same id, only those with a passage of the benchmark are leaks."""
    items = spark.createDataFrame([(1, TEXT)], "item_id bigint, text string")
    clean = "a clean text that has nothing to do with any passage of the benchmark"
    docs = [(None, TEXT), (None, clean), (None, None), (5, TEXT + " more"), (5, clean), (5, TEXT + " more"), (6, clean)]
    docs = spark.createDataFrame([(*r, "x") for r in docs], "doc_id bigint, text string, text_hash string")
    monkeypatch.setattr(queries, "table", lambda spark, sf_dir, name: items)
    kept = corpus_pipeline.drop_leaks(spark, docs, SF)
    assert kept.columns == docs.columns
    assert sorted((str(r.doc_id), str(r.text)) for r in kept.collect()) == sorted([("5", clean), ("6", clean), ("None", clean), ("None", "None")])
    found = decontaminate.find_leaks(docs, items).select("doc_id", "text_hash").collect()
    assert len(found) == len(set(found)) == 2


@pytest.fixture(scope="module")
def staged(spark):
    """The pipeline's documents before and after each stage."""
    out, docs = [], documents(spark, SF)
    for name, stage in corpus_pipeline.STAGES:
        kept = corpus_pipeline.written(stage(spark, docs, SF), name)
        out.append((name, docs, kept))
        docs = kept
    return out


def test_stages_against_brute_force(spark, staged):
    from test_ngrams_and_strings import shingles

    by = {name: ({r.doc_id: r for r in before.collect()}, after.collect()) for name, before, after in staged}
    assert [n for n, _, _ in staged] == ["toxicity", "exact_dedup", "near_dedup", "decontaminate", "pack"]
    for name, before, after in staged[:-1]:
        assert after.columns == before.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        old, new = by[name]
        assert all(old[r.doc_id] == r for r in new) and len(new) == len({r.doc_id for r in new})
    old, new = by["toxicity"]
    toxic = {r.doc_id for r in toxicity.score_toxicity(staged[0][1], queries.table(spark, SF, "labels")).collect() if r.predicted}
    assert {r.doc_id for r in new} == set(old) - toxic and toxic
    old, new = by["exact_dedup"]
    keep = {}
    for i in sorted(old):
        keep[old[i].text.translate({c: c + 32 for c in range(65, 91)})] = i
    assert {r.doc_id for r in new} == set(keep.values())
    old, new = by["near_dedup"]
    sets = {i: shingles(r.text) for i, r in old.items()}
    ids, up = sorted(old), {i: i for i in old}
    find = lambda x: x if up[x] == x else find(up[x])
    for a, i in enumerate(ids):
        for j in ids[:a]:
            if len(sets[i]) <= 1.25 * len(sets[j]) and len(sets[j]) <= 1.25 * len(sets[i]) and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) - 1e-9:
                up[max(find(i), find(j))] = min(find(i), find(j))
    assert {r.doc_id for r in new} == {find(i) for i in ids}
    old, new = by["decontaminate"]
    bench = [(r.item_id, r.text) for r in queries.table(spark, SF, "benchmark").collect()]
    assert {r.doc_id for r in new} == set(old) - {i for i, _ in brute_leaks([(i, r.text) for i, r in old.items()], bench)}
    old, new = by["pack"]
    assert {r.doc_id for r in new} == set(old)
    assert {r.doc_id for r in corpus_pipeline.run(spark, SF).collect()} == set(old)


def test_stages_on_messy_and_empty_tables(spark, messy, nothing):
    for start in (messy, nothing):
        docs = start
        for name, stage in corpus_pipeline.STAGES[:-1]:
            kept = corpus_pipeline.written(stage(spark, docs, SF), name)
            assert kept.columns == start.columns
            docs = kept
        assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == (0 if start is nothing else docs.count() + sum(-(-len(queries_ids(r.text)) // 1024) - 1 for r in docs.collect()))
        if start is messy:
            texts = [(r.text or "").lower() for r in docs.collect()]
            assert len(texts) == len(set(texts)) and TEXT.lower() in texts


def queries_ids(text):
    import public_tokenizers
    from tokenizers import Tokenizer

    library = queries_ids.__dict__.setdefault("t", Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")))
    return [*library.encode(text or "", add_special_tokens=False).ids, 2]


def edited(rng, text, kind):
    """An item with an edit that keeps at least 0.8 of its shingles' weight, or about that."""
    w = words(text)
    n = len(w)
    if kind == "repeated":      # the last ninth becomes one repeated word: many equal shingles
        k = round(n * 0.105)
        return " ".join(w[: n - k] + ["again"] * k)
    if kind == "repeated inside":
        k, at = round(n * 0.1), n // 2
        return " ".join(w[:at] + ["ha"] * k + w[at + k:])
    if kind == "replaced":
        return " ".join("other" + str(rng.randrange(99)) if n * 0.4 < i < n * 0.4 + n * 0.07 else x for i, x in enumerate(w))
    return " ".join(w[: round(n * 0.9)])


@pytest.mark.parametrize("similarity", [0.8])
def test_leaks_with_repeated_shingles_are_found(spark, similarity):
    """Recall over edits of long items, also those that put one shingle many times into the window."""
    rng = random.Random(12)
    vocabulary = [f"w{k}" for k in range(900)]
    items, docs = [], []
    for k in range(160):
        text = " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(60, 200)))
        if k % 4 == 0:          # an item with repeats of its own
            text += " " + " ".join(["la"] * 30)
        items.append((k, text))
        body = edited(rng, text, ["repeated", "repeated inside", "replaced", "cut"][k % 4 if k % 8 else 1])
        docs.append((1000 + k, " ".join(rng.choice(vocabulary) for _ in range(40)) + " " + body + " " + " ".join(rng.choice(vocabulary) for _ in range(40))))
    want = {(i, j) for (i, t), (j, x) in zip(docs, items) if (i, j) in brute_leaks([(i, t)], [(j, x)], similarity)}
    found = decontaminate.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), similarity)
    got = {(r["doc_id"], r["item_id"]) for r in found.collect()}
    assert len(want) > 70
    assert got == want


def test_similarity_of_counts_is_one_of_occurrences(spark):
    rows = spark.createDataFrame([(1, 7, 3), (1, 8, 1), (2, 7, 2), (2, 9, 1)], "g int, h long, c long")
    sets = {}
    for r in decontaminate.occurrences(rows, ["g"]).collect():
        sets.setdefault(r["g"], []).append(r["h"])
    assert {g: len(set(x)) for g, x in sets.items()} == {1: 4, 2: 3}
    assert len(set(sets[1]) & set(sets[2])) == 2     # the smaller count of 7
