"""Operators 11 to 13 against brute force, with their routes forced and on messy rows."""

import collections
import itertools
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from chanwh.llm import divergence, lexical_search, outliers, queries
from llm_cases import documents

SF001 = "/root/testdata/sf0.001"


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def plain_audit(rows, least=3, most=200):
    """The contract, written down term by term: {(lang, source, part, item): (value, rank)}."""
    texts = [((lang or ""), (source or ""), re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower(t))) for lang, source, t in rows]
    out = {}
    for lang in {x for x, *_ in texts}:
        df = collections.Counter(t for own, _, terms in texts if own == lang for t in set(terms))
        kept = [t for t, n in df.items() if n >= least]
        count = {s: collections.Counter() for own, s, _ in texts if own == lang}
        for own, s, terms in texts:
            if own == lang:
                count[s].update(t for t in terms if df[t] >= least)
        whole = sum(count.values(), collections.Counter())
        share = lambda c: {t: 1 + 10**9 * (c[t] + 1) // (c.total() + len(kept)) for t in kept}
        p, q = {s: share(c) for s, c in count.items()}, share(whole)
        for s in count:
            pairs = {o: sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept) for o in count if o != s}
            terms = {t: (p[s][t] - q[t]) ** 2 // q[t] for t in kept if count[s][t] and p[s][t] > q[t]}
            for part, values, cut in (("pair", pairs, None), ("term", terms, most)):
                for rank, (item, v) in enumerate(sorted(values.items(), key=lambda x: (-x[1], x[0].encode()))[:cut], 1):
                    out[lang, s, part, item] = (v, rank)
    return out


def audited(df, **options):
    rows = divergence.audit_sources(df, **options).collect()
    out = {(r["lang"], r["source"], r["part"], r["item"]): (r["value"], r["rank"]) for r in rows}
    assert len(out) == len(rows)
    return out


def corpus(seed=3, n=160):
    rng = random.Random(seed)
    words = [f"{a}{b}" for a in "abcdefg" for b in ("x", "É", "ß日", "q-", "Z")]
    rows = []
    for i in range(n):
        lang, source = rng.choice(["en", "en", "de", None]), f"s{rng.randrange(7)}"
        rows.append((lang, source, " ".join(rng.choice(words[: 10 + 3 * int(source[1])]) for _ in range(rng.randrange(0, 40)))))
    return rows + [("fr", "only", "un deux"), ("xx", "a", "rare"), ("xx", "b", None), (None, None, None), ("", "s1", "\x00\t9")]


@pytest.mark.parametrize("route", ["broadcast", "shuffle"])
def test_audit_equals_the_contract(spark, monkeypatch, route):
    monkeypatch.setattr(divergence, "SHARD_KEYS", 5)
    monkeypatch.setattr(divergence, "TILE", 2)
    monkeypatch.setattr(divergence, "HELD", 40)
    rows = corpus()
    df = spark.createDataFrame(rows, "lang string, source string, text string").repartition(5)
    assert audited(df, top_terms=6, broadcast_bytes=1 << 20 if route == "broadcast" else 0) == plain_audit(rows, most=6)


def test_audit_of_documents_and_messy_rows(spark, messy, nothing):
    docs = documents(spark, SF001)
    rows = [tuple(r) for r in docs.select("lang", "source", "text").collect()]
    assert audited(docs) == plain_audit(rows)
    copies = messy.crossJoin(spark.range(3)).drop("id").withColumns({"lang": F.lit("x"), "source": F.col("doc_id").cast("string"), "id": F.lit(1)})
    rows = [tuple(r) for r in copies.select("lang", "source", "text").collect()]
    assert audited(copies) == plain_audit(rows)
    assert audited(messy) == plain_audit([(None, None, r["text"]) for r in messy.collect()])
    assert audited(nothing) == {}


def test_perfect_hash_finds_its_keys_and_nothing_else(monkeypatch):
    keys = [f"k{i}é".encode() for i in range(3000)]
    one = divergence.PerfectHashes([{**divergence.perfect_hash(keys), "shard": 0}])
    found, _, slot = one.find(keys + [b"other", b"", *(f"o{i}".encode() for i in range(5000))])
    assert list(found) == list(range(3000)) and sorted(slot) == list(range(3000))
    # keys that no hash tells apart are kept in a list
    monkeypatch.setattr(divergence, "hashes", lambda terms: np.array([len(t) for t in terms], np.uint64))
    same = divergence.PerfectHashes([divergence.perfect_hash([b"ab", b"cd", b"e"])])
    found, _, slot = same.find([b"cd", b"zz", b"e", b"ab"])
    assert list(found) == [0, 2, 3] and sorted(slot) == [0, 1, 2]


def test_shares_are_exact_beyond_64_bits():
    count, total = np.array([10**15, 3, 1]), 10**15 + 7
    assert list(divergence.share(count, total)) == [1 + 10**9 * int(c) // total for c in count]


def test_hash_of_terms_is_sparks(spark):
    terms = ["a", "É", "日本語", "x" * 100]
    own = spark.createDataFrame([(t,) for t in terms], "t string").select(F.xxhash64(F.col("t").cast("binary"))).collect()
    assert [r[0] % 2**64 for r in own] == [int(h) for h in divergence.hashes([t.encode() for t in terms])]


def plain_statistics(t):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    grams = collections.Counter(zip(w, w[1:], w[2:]))
    covered = {k for i, g in enumerate(zip(w, w[1:], w[2:])) if grams[g] > 1 for k in (i, i + 1, i + 2)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered)


def plain_outliers(x):
    """Final squared distances of one cell, with dense linear algebra."""
    def distances(mean, cov):
        z = x - mean
        return (z @ np.linalg.inv(cov + outliers.RESOLUTION**2 * np.eye(4)) * z).sum(1), np.linalg.det(cov + outliers.RESOLUTION**2 * np.eye(4))

    def fit(mask, share):
        return x[mask].mean(0), outliers.consistency(share) * np.cov(x[mask].T, bias=True)

    median = lambda v: np.sort(v, 0)[(len(v) - 1) // 2]
    mid = median(x)
    ends = []
    for mean, cov in ((mid, np.diag((1.4826 * median(abs(x - mid))) ** 2)), (x.mean(0), np.cov(x.T, bias=True))):
        for _ in range(outliers.STEPS):
            d2, _ = distances(mean, cov)
            key = np.floor(outliers.BINS * np.log(1 + d2))
            limit = np.sort(key)[math.ceil(outliers.SHARE * len(x)) - 1]
            mean, cov = fit(key <= limit, outliers.SHARE)
        ends.append((distances(mean, cov)[1], mean, cov))
    _, mean, cov = min(ends, key=lambda e: e[0])
    inside = distances(mean, cov)[0] <= 11.143286781877796
    return distances(*fit(inside, 0.975))[0]


def test_statistics_equal_brute_force(spark, messy):
    own = spark.createDataFrame([(i, t) for i, t in enumerate(["a b c a b c a b", "x\nx \nx\n\n \t\ny", "# $ % a|b <c> & *", "a b c d", "é é 🙂 b", "b c a b c", " a  b\r\nc a b c "])], "doc_id long, text string")
    for df in (own, messy, documents(spark, SF001)):
        rows = outliers.statistics(df.select("text", F.lit(1).alias("id")), ["id"], "text").drop("id").collect()
        assert sorted(map(tuple, rows)) == sorted(plain_statistics(r["text"]) for r in df.select("text").collect())


def test_outliers_equal_dense_estimates(spark, monkeypatch):
    monkeypatch.setattr(outliers, "LEAST", 25)
    rng = np.random.default_rng(5)
    rows = []
    for i in range(700):
        lang, source = ("en", f"s{i % 4}") if i % 3 else ("de", f"d{i % 20}") if i % 2 else ("fr", "few" if i % 5 else None)
        n = int(rng.integers(55, 400))
        words = ["".join(rng.choice(list("abcdefghij"), rng.integers(2, 9 if lang == "en" else 12))) for _ in range(n)]
        if i % 17 == 0:
            words = [w + "#|" for w in words]
        if i % 23 == 0:
            words = words[: n // 2] * 2
        rows.append((i, lang, source, " ".join(words) if i % 50 else "short"))
    df = spark.createDataFrame(rows, "doc_id long, lang string, source string, text string").repartition(4)
    found = {r["doc_id"]: r for r in outliers.judge_quality(df).collect()}
    assert len(found) == 700
    stats = {i: plain_statistics(t) for i, _, _, t in rows}
    ok = {i for i, (n, _, _, _, r) in stats.items() if n >= 50 and 100 * r <= 50 * n}
    sizes = collections.Counter((lang, source or "") for i, lang, source, _ in rows if i in ok)
    pools = collections.Counter()
    for (lang, _), n in sizes.items():
        pools[lang] += n if n < 25 else 0
    cells = collections.defaultdict(list)
    for i, lang, source, _ in rows:
        if i in ok:
            key = (lang, source or "")
            cells[key if sizes[key] >= 25 else (lang, None) if pools[lang] >= 25 else (None, None)].append(i)
    assert {k[1] is None for k in cells} == {True, False}
    for key, ids in cells.items():
        x = np.array([[math.floor(1000 * math.log(v) + 0.5) for v in (c / n, 1 + 10 * s / (n + 100), 1 + 100 * d / (n + 100), 1 + 10 * r / (n + 100))]
                      for n, c, s, d, r in (stats[i] for i in ids)], float)
        if len(ids) >= 25:
            d2 = plain_outliers(x)
            assert np.allclose([found[i]["distance"] for i in ids], d2, rtol=1e-9, atol=1e-9)
            assert [found[i]["kept"] for i in ids] == list(d2 <= 18.466826952903148)
            assert {tuple(found[i]["cell"]) for i in ids} == {key}
    assert all(found[i]["base_failed"] == (i not in ok) and (i in ok or not found[i]["kept"]) for i in found)
    assert sum(not found[i]["kept"] for i in ok if i % 17 == 0) > 20 and all(found[i]["kept"] for i in ok if i % 17 and i % 23)


def test_quality_of_messy_and_few_rows(spark, messy, nothing):
    found = outliers.judge_quality(messy)
    assert found.columns[0] == "doc_id" and found.count() == messy.count()
    assert all(r["kept"] != r["base_failed"] and r["distance"] is None for r in found.collect())
    assert outliers.judge_quality(nothing).count() == 0


def plain_search(docs, items, most=50):
    terms = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower(t))
    counts = [(i, c) for i, t in docs if (c := collections.Counter(terms(t)))]
    n, length = len(counts), sum(c.total() for _, c in counts)
    df = collections.Counter(t for _, c in counts for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, c in counts:
            m = 100 - 50 + (50 * c.total() * n) // length
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m)) for t in set(terms(text)) if t in c)
            if s > 0:
                scores.append((-s, i is None, i or 0, i))
        out += [(item, rank, i, -s) for rank, (s, *_, i) in enumerate(sorted(scores, key=lambda x: x[:3])[:most], 1)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("width, rows", [(16, 7), (512, 64), (8192, 256)])
def test_search_equals_brute_force(spark, monkeypatch, width, rows):
    monkeypatch.setattr(lexical_search, "BLOCK_ITEMS", 90)
    docs, items = documents(spark, SF001), queries.table(spark, SF001, "benchmark")
    found = lexical_search.search(docs.repartition(3), items, most=20, width=width, batch_rows=rows).select("item_id", "rank", "doc_id", "score")
    assert sorted(map(tuple, found.collect()), key=repr) == plain_search([tuple(r) for r in docs.select("doc_id", "text").collect()], [tuple(r) for r in items.select("item_id", "text").collect()], 20)


def test_search_of_messy_rows(spark, messy, nothing):
    items = [(1, "quick 日本 brown w5x5"), (1, "only here"), (None, "fox a"), (2, None), (3, "!?"), (4, "unknownword"), (5, "a A b")]
    asked = spark.createDataFrame(items, "item_id int, text string")
    found = lexical_search.search(messy, asked, most=4)
    assert dict(found.dtypes) == {"item_id": "int", "rank": "int", "doc_id": "bigint", "score": "bigint"}
    own = [(r["doc_id"], r["text"]) for r in messy.collect()]
    assert sorted(map(tuple, found.collect()), key=repr) == plain_search(own, items, 4)
    assert lexical_search.search(nothing, asked).count() == 0
    assert lexical_search.search(messy, asked.limit(0)).count() == 0


def test_bounds_are_never_below_scores(spark):
    rng = random.Random(9)
    words = [f"w{i}".encode() for i in range(300)]
    counts = [collections.Counter(rng.choices(words, k=rng.randrange(1, 200))) for _ in range(80)]
    n, length = len(counts), sum(c.total() for c in counts)
    df = collections.Counter(itertools.chain.from_iterable(counts))
    weights = [{t: lexical_search.weight(n, df[t]) for t in rng.sample(words, 25)} for _ in range(30)]
    best = lexical_search.Best(lexical_search.Block(weights, n, length, 64), 5)
    m = [lexical_search.length_part(c.total(), n, length) for c in counts]
    bounds = (lexical_search.sketches(counts, m, 64) @ best.matrix).astype(float) * lexical_search.MARGIN
    exact = np.array([[best.score(q, c, k) for q in range(30)] for c, k in zip(counts, m)])
    assert (bounds >= exact).all() and (bounds >= 1)[exact > 0].all()
