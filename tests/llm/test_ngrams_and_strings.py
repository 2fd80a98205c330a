import hashlib
import random
from collections import defaultdict
from itertools import combinations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from chanwh.llm import components, ngram_join, suffix_dedup
from chanwh.llm.suffix_sort import deep_shallow_sort

from llm_cases import messy_rows


def shingles(text):
    w = (text or "").lower().split()
    return {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def brute_classes(rows):
    """(links, class id, kept ids) of rows by all pairs."""
    sets = [shingles(t) for _, t in rows]
    links, up = [0] * len(rows), list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in combinations(range(len(rows)), 2):
        same = len(sets[a] & sets[b])
        if (rows[a][1] or "") == (rows[b][1] or "") or (same and same >= 0.8 * len(sets[a] | sets[b]) - 1e-9):
            links[a] += 1
            links[b] += 1
            up[max(find(a), find(b))] = min(find(a), find(b))
    least = defaultdict(list)
    for k, (i, _) in enumerate(rows):
        least[find(k)].append(i)
    smallest = {k: min((i for i in g if i is not None), default=None) for k, g in least.items()}
    return [(str(rows[k][0]), str(smallest[find(k)]), links[k], len(least[find(k)])) for k in range(len(rows))]


def near_copies(n, words=60, seed=3):
    rng = random.Random(seed)
    base = [f"b{k}" for k in range(words)]
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randrange(3)):
            w[rng.randrange(words)] = f"x{rng.randrange(10**6)}"
        out.append(" ".join(w))
    return out


def check_join(spark, rows):
    df = spark.createDataFrame([(i, t, 7) for i, t in rows], "doc_id bigint, text string, row int")
    got = ngram_join.similar_texts(df).collect()
    assert sorted((str(r.doc_id), str(r.class_id), r.n_links, r.class_size) for r in got) == sorted(brute_classes(rows))
    kept = defaultdict(int)
    for r in got:
        kept[str(r.class_id), r.class_size] += r.kept
    assert sum(kept.values()) == len({tuple(x[1:2]) for x in brute_classes(rows)}) or all(kept.values())


def test_join_against_all_pairs(spark):
    check_join(spark, [(r[0], r[1]) for r in messy_rows()])


def test_join_of_a_large_group_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK", 8)
    monkeypatch.setattr(ngram_join, "UNIT_ROWS", 20)
    monkeypatch.setattr(ngram_join, "BROADCAST_ROWS", 0)
    texts = near_copies(60) + near_copies(12, seed=9)[:6] + [f"unlike any other {k} in all of its words" for k in range(20)]
    check_join(spark, [(1000 - k, t) for k, t in enumerate(texts)])


def test_join_nothing(nothing):
    assert ngram_join.similar_texts(nothing).count() == 0


def test_stop_depth_reaches_the_recall():
    d = ngram_join.stop_depth(0.8)
    assert 1 - (1 - 0.8**d) ** ngram_join.TREES >= ngram_join.RECALL > 1 - (1 - 0.8 ** (d + 1)) ** ngram_join.TREES


def test_shingles_of_long_texts_do_not_depend_on_chunks(monkeypatch):
    text = " ".join(f"w{k * k % 1009}" for k in range(5_000))
    whole = ngram_join.shingle_hashes(text)
    monkeypatch.setattr(ngram_join, "CHUNK", 700)
    assert np.array_equal(whole, ngram_join.shingle_hashes(text)) and len(whole) == len(shingles(text))


def test_components(spark):
    rng = random.Random(5)
    links = [(k, k + 1) for k in range(100, 160)] + [(500, k) for k in range(600, 640)] + [(rng.randrange(1000, 1200), rng.randrange(1000, 1200)) for _ in range(120)] + [(7, 7)]
    up = {}
    find = lambda x: x if up.setdefault(x, x) == x else find(up[x])
    for a, b in links:
        up[max(find(a), find(b))] = min(find(a), find(b))
    got = {r.node: r.component for r in components.connected_components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {x: find(x) for x in up if any(find(y) == find(x) for y in up if y != x)}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(min_size=13, max_size=13) | st.text("ab", min_size=13, max_size=13).map(str.encode), max_size=30), st.sampled_from([0, 8, 16]))
def test_deep_shallow_sort(strings, shallow):
    rows = np.array([list(s) for s in strings], np.uint8).reshape(len(strings), 13)
    order, common = deep_shallow_sort(rows, shallow)
    by = [strings[k] for k in order]
    assert by == sorted(strings) and sorted(order) == list(range(len(strings)))
    for k in range(1, len(by)):
        assert common[k] == next((n for n, (a, b) in enumerate(zip(by[k - 1], by[k])) if a != b), 13)


def brute_strings(rows):
    """Bytes removed, runs and hash of the rest, by a set of all windows in the order of documents."""
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0))
    seen, out = set(), [None] * len(rows)
    for k in order:
        b = (rows[k][1] or "").encode()
        gone = bytearray(len(b))
        for s in range(len(b) - 99):
            if b[s:s + 100] in seen:
                gone[s:s + 100] = b"\1" * 100
            seen.add(b[s:s + 100])
        rest = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for i in range(len(b)) if gone[i] and (i == 0 or not gone[i - 1]))
        out[k] = (str(rows[k][0]), len(b), sum(gone), spans, hashlib.sha256(rest).hexdigest())
    return sorted(out)


def check_strings(spark, rows):
    df = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id bigint, text string, h int, t int")
    got = [(str(r.doc_id), *r[1:]) for r in suffix_dedup.deduplicate_strings(df).collect()]
    assert sorted(got) == brute_strings(rows)


def passages(seed):
    rng = random.Random(seed)
    line = "".join(rng.choice("abcdefgh ") for _ in range(260))
    out = []
    for k in range(60):
        own = "".join(rng.choice("abcdefgh ") for _ in range(rng.randrange(400)))
        a, n = rng.randrange(200), rng.randrange(20, 260)
        at = rng.randrange(len(own) + 1)
        out.append((k * 7 % 60, own[:at] + line[a:a + n] + own[at:] + (own[:150] if k % 7 == 0 else "")))
    return out + [(100, "z" * 1_000), (101, "z" * 150), (102, "zy" * 300), (103, "é" * 120), (104, line), (None, line), (105, None), (106, "")]


ROUTES = {"plain": {}, "small buckets": {"BUCKET": 40, "SORTED": 10}, "spread": {"SPREAD": 1, "BUCKET": 60}, "hot": {"HOT": 1, "BUCKET": 60},
          "steps": {"STEP": 128, "BROADCAST_ROWS": 0, "SPREAD": 3, "HOT": 4}}


@pytest.mark.parametrize("route", ROUTES)
def test_strings_against_all_windows(spark, monkeypatch, route):
    for name, value in ROUTES[route].items():
        monkeypatch.setattr(suffix_dedup, name, value)
    check_strings(spark, passages(len(route)))


def test_strings_of_messy_rows(spark, nothing):
    # rows with the same id and different texts have no order in the contract: one id each here
    rows = [(r[0], r[1]) for r in messy_rows() if r[1] not in ("same id, another text entirely", "only here, with no id at all")]
    check_strings(spark, [r if len(r[1] or "") < 10_000 else (r[0], r[1][:20_000]) for r in rows])
    assert suffix_dedup.deduplicate_strings(nothing).count() == 0


def test_equal_ids_lose_a_shared_passage_once(spark):
    rng = random.Random(1)
    shared = "".join(rng.choice("abcdef ") for _ in range(300))
    df = spark.createDataFrame([(1, "x" * 50 + shared), (1, shared + "y" * 50)], "doc_id bigint, text string")
    assert sorted(r.n_removed for r in suffix_dedup.deduplicate_strings(df).collect()) == [0, 300]
