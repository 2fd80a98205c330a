import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from chanwh.llm import packing, queries, sharding, token_counts

from llm_cases import messy_rows

MODEL = public_tokenizers.path("piece_bpe_32k.model")
VOCABULARY, RANKS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")
ODD = ["", " ", "  ", "\n", " \n ", "\n\n a", "a\n", "a  b   c    d", "\t\ttab", "a\r\nb", "▁x ▁", "<s> </s><unk> <0x0A>", "x" * 5_000, "日本語 テスト", "🙂🙂 ﬁ①", "a b　c", "é", "\x00\x01", " lead", "trail ",
       "<|endoftext|> in text", "don't we'll I'M", "1234 56", "a\x1cb\x85c", "ſpecial ǅ ß"]


def test_counts_are_the_librarys(spark, messy):
    processor = token_counts.load(MODEL)
    rows = list(enumerate(ODD)) + [(None, None)]
    got = token_counts.count_tokens(spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id bigint, text string, id int"), MODEL, limit=3).collect()
    assert sorted(map(str, got)) == sorted(f"Row(doc_id={i}, n_bytes={len((t or '').encode())}, n_tokens={n}, over_limit={n > 3})" for i, t in rows for n in [len(processor.encode(t or ""))])
    assert sorted((str(r.doc_id), r.n_tokens) for r in token_counts.count_tokens(messy, MODEL).collect()) == sorted((str(r[0]), len(processor.encode(r[1] or ""))) for r in messy_rows())


def test_whole_token_table_is_proved():
    processor = token_counts.load(MODEL)
    table = token_counts.whole_tokens(processor)
    assert len(table) > 20_000 and token_counts.pretoken_pattern(processor)
    for piece in random.Random(2).sample(sorted(table), 300):
        assert token_counts.merged(processor, piece) == 1


@settings(max_examples=150, deadline=None)
@given(st.text(st.sampled_from("ab theing \n\té日🙂.,'▁<s>0") | st.characters(codec="utf-8"), max_size=60))
def test_counts_of_any_text(text):
    processor = test_counts_of_any_text.__dict__.setdefault("p", token_counts.load(MODEL))
    import re

    counter, cut = token_counts.Counter(processor, {}), re.compile(token_counts.pretoken_pattern(processor)).findall
    if text and token_counts.MARK not in text:
        assert sum(map(counter.__getitem__, cut(" " + text))) == len(processor.encode(text))


@pytest.fixture(scope="module")
def encoder():
    return packing.Encoder(VOCABULARY, RANKS, public_tokenizers.PATTERN)


def library_ids(encoder, text):
    return encoder.library.encode(text, add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(st.text(st.characters(codec="utf-8", max_codepoint=0x2100) | st.sampled_from(" \n'sab.1"), max_size=50))
def test_fast_ids_are_the_librarys(text):
    encoder = test_fast_ids_are_the_librarys.__dict__.setdefault("e", packing.Encoder(VOCABULARY, RANKS, public_tokenizers.PATTERN))
    assert encoder.ids(text).tolist() == library_ids(encoder, text)


def test_fast_ids_of_every_plain_character(encoder):
    plain = [chr(c) for c in range(0x2100) if packing.PLAIN.fullmatch(chr(c))]
    assert len(plain) > 600
    for c in plain:
        for text in (c, f"a{c}b", f" {c} ", f"{c}{c}1{c}\n{c}"):
            assert encoder.ids(text).tolist() == library_ids(encoder, text), repr(c)
    for text in ODD:
        assert encoder.ids(text).tolist() == library_ids(encoder, text), repr(text)


@pytest.mark.parametrize("text", [" " * 2_000_000, "\n" * 2_000_000, "a" + " \n" * 900_000 + "b", "abcde" * 1_000_000, "!" * 1_500_000, ("x" + " " * 499) * 400, "a" * 1999 + " " + "1" * 1999])
def test_long_runs_have_the_librarys_ids(encoder, text):
    assert np.array_equal(encoder.ids(text), library_ids(encoder, text))


def test_long_runs_are_packed(spark, encoder):
    rows = [(1, " " * 2_000_000), (2, "\n" * 2_000_000), (3, "w" * 5_000_000), (4, "short")]
    got = packing.pack_documents(spark.createDataFrame(rows, "doc_id long, text string"), VOCABULARY, RANKS, public_tokenizers.PATTERN).toPandas()
    lengths = got.groupby("doc_id")["length"].sum()
    assert {i: len(library_ids(encoder, t)) + 1 for i, t in rows} == lengths.to_dict()


def check_packing(rows, got, encoder, length):
    """Exact pieces, and sequences without gaps; returns the number of sequences."""
    want = []
    for i, t in rows:
        ids = np.array(library_ids(encoder, t or "") + [2], "<u4")
        first = len(ids) % length or length
        cuts = [0, *range(first, len(ids) + 1, length)]
        want += [(str(i), k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    assert sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted(want)
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for s in sequences.values():
        at = 0
        for offset, n in sorted(s):
            assert offset == at
            at += n
        assert at <= length
    return len(sequences)


def test_packing_round_trip(messy, nothing, encoder):
    got = queries.pack(messy).collect()
    rows = [(r[0], r[1]) for r in messy_rows()]
    n = check_packing(rows, got, encoder, 1024)
    total = sum(r.length for r in got)
    assert -(-total // 1024) <= n <= -(-total // 1024) + 1
    assert queries.pack(nothing).count() == 0


def test_groups_with_gaps_exchange(spark, encoder, monkeypatch):
    rng = random.Random(4)
    rows = [(k, " the" * rng.randrange(0, 63)) for k in range(300)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    pack = lambda: packing.pack_documents(df, VOCABULARY, RANKS, public_tokenizers.PATTERN, length=64).collect()
    monkeypatch.setattr(packing, "FIRST_GROUP", 15)
    monkeypatch.setattr(packing, "ROUNDS", 1)
    alone = check_packing(rows, pack(), encoder, 64)
    monkeypatch.setattr(packing, "ROUNDS", 6)
    exchanged = check_packing(rows, pack(), encoder, 64)
    sizes = np.array([len(library_ids(encoder, t)) + 1 for _, t in rows])
    together = len(packing.best_fit_decreasing(sizes, 64)[2])
    # groups of 15 pieces cannot reach one group of all, but the exchange wins back most of the loss
    assert packing.lower_bound(sizes, 64) <= together <= exchanged and exchanged - together <= (alone - together) * 0.6


def fewest_bins(sizes, capacity):
    """Exact, by search."""
    best = [len(sizes)]

    def put(k, bins):
        if len(bins) >= best[0]:
            return
        if k == len(sizes):
            best[0] = len(bins)
            return
        for j in range(len(bins)):
            if bins[j] + sizes[k] <= capacity:
                put(k + 1, [*bins[:j], bins[j] + sizes[k], *bins[j + 1:]])
        put(k + 1, [*bins, sizes[k]])

    put(0, [])
    return best[0]


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 20), min_size=0, max_size=9))
def test_bound_and_fit(sizes):
    exact = fewest_bins(sorted(sizes, reverse=True), 20)
    array = np.array(sizes, np.int64)
    bins, offsets, left = packing.best_fit_decreasing(array, 20)
    assert packing.lower_bound(array, 20) <= exact <= len(left)
    for b in range(len(left)):
        inside = sorted((o, s) for o, s, x in zip(offsets.tolist(), sizes, bins.tolist()) if x == b)
        assert [o for o, _ in inside] == [sum(s for _, s in inside[:k]) for k in range(len(inside))] and sum(s for _, s in inside) == 20 - left[b]


def test_bound_beats_the_sum():
    assert packing.lower_bound(np.array([11] * 10), 20) == 10  # no two fit together
    assert packing.lower_bound(np.array([7] * 9), 20) == 5  # two to a sequence
    assert packing.lower_bound(np.array([], np.int64), 20) == 0


def check_shards(rows, got, shards):
    assert sorted((str(r["doc_id"]), r["size"], r["text_crc32"]) for r in got) == sorted((str(i), len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in rows)
    counts = [0] * shards
    slots = {}
    for r in got:
        counts[r["shard"]] += 1
        slots.setdefault(r["shard"], []).append(r["slot"])
        assert r["law"] == "rows" and r["grown_shard"] is None
    assert max(counts) - min(counts) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_shards_are_exact(spark, messy, nothing, monkeypatch):
    rows = [(r[0], r[1]) for r in messy_rows()]
    check_shards(rows, [r.asDict() for r in sharding.shard_rows(messy, 5).collect()], 5)
    monkeypatch.setattr(sharding, "ROWS_PER_TASK", 40)
    many = [(k, f"text {k % 7}") for k in range(1003)] + [(5, "text 5")] * 200
    df = spark.createDataFrame(many, "doc_id bigint, text string").repartition(5)
    once = [r.asDict() for r in sharding.shard_rows(df, 40).collect()]
    check_shards(many, once, 40)
    again = [r.asDict() for r in sharding.shard_rows(df.repartition(3), 40).collect()]
    assert sorted(map(str, once)) == sorted(map(str, again))  # the rows decide, not their partitions
    other = [r.asDict() for r in sharding.shard_rows(df, 40, seed=18).collect()]
    assert sorted(map(str, once)) != sorted(map(str, other))
    assert sharding.shard_rows(nothing, 40).count() == 0


def test_shuffle_is_uniform(spark):
    df = spark.range(4000).selectExpr("id as doc_id", "'x' as text")
    got = sharding.shard_rows(df, 8).toPandas()
    # shard and slot are independent of the id: all eighths of the ids meet all shards alike
    table = np.zeros((8, 8))
    np.add.at(table, (got["doc_id"] * 8 // 4000, got["shard"]), 1)
    assert ((table - 62.5) ** 2 / 62.5).sum() < 110  # 49 degrees of freedom
    assert abs(np.corrcoef(got["doc_id"], got["slot"])[0, 1]) < 0.06


def test_matrix_margins_and_distribution():
    matrix = np.array(sharding.communication_matrix([100, 0, 37, 260], 7, seed=3))
    assert matrix.sum(axis=1).tolist() == [100, 0, 37, 260] and set(matrix.sum(axis=0)) <= {56, 57}
    rng = np.random.default_rng(1)
    big = np.array([sharding.hypergeometric(rng, 2 * 10**9, 6 * 10**9, 10**6) for _ in range(400)])
    assert abs(big.mean() - 250_000) < 5 * 433 / 20 and 0.8 < big.std() / 433 < 1.2
    assert sharding.hypergeometric(rng, 0, 5, 3) == 0 and sharding.hypergeometric(rng, 3 * 10**9, 0, 7) == 7
    small = np.array([sharding.hypergeometric(rng, 5, 5, 5) for _ in range(2000)])
    assert abs(small.mean() - 2.5) < 0.1
