import hashlib
import re
from collections import defaultdict

from chanwh.llm import exact_dedup, url_filter

from llm_cases import messy_rows


def lower(s):
    return (s or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


def test_copies_against_brute_force(messy):
    got = exact_dedup.deduplicate(messy).collect()
    rows = [(r[0], lower(r[1])) for r in messy_rows()]
    groups = defaultdict(list)
    for i, t in rows:
        groups[t].append(i)
    keep = {t: max((i for i in g if i is not None), default=None) for t, g in groups.items()}
    want = sorted((str(i), str(keep[t]), len(groups[t]), hashlib.sha256(t.encode()).hexdigest()) for i, t in rows)
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.text_sha256) for r in got) == want
    kept = defaultdict(int)
    for r in got:
        kept[r.text_sha256] += r.kept
        assert not r.kept or r.doc_id == r.keep_id
    assert set(kept.values()) == {1} and len(kept) == len(groups)


def test_index_outlives_a_batch(spark):
    make = lambda rows: spark.createDataFrame(rows, "doc_id bigint, text string")
    index = exact_dedup.DigestIndex(spark, buckets=4)
    first = exact_dedup.deduplicate(make([(1, "one"), (2, "ONE"), (3, "two")]), index)
    assert {(r.doc_id, r.keep_id, r.kept) for r in first.collect()} == {(1, 2, False), (2, 2, True), (3, 3, True)}
    # the files are the index: another session's table over the same path sees what was appended
    again = exact_dedup.DigestIndex(spark, path=index.path, buckets=4)
    second = exact_dedup.deduplicate(make([(10, "two"), (11, "three")]), again)
    assert {(r.doc_id, r.keep_id, r.kept) for r in second.collect()} == {(10, 3, False), (11, 11, True)}
    assert sorted(r.keep_id for r in again.table().collect()) == [2, 3, 11]
    plan = again.table()._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan or "Bucketed: false (disabled" in plan or "SelectedBucketsCount" in plan


def test_no_documents(nothing):
    out = exact_dedup.deduplicate(nothing)
    assert out.count() == 0 and out.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]


def judged(url):
    u = url or ""
    rest = u.split("://", 1)[1] if "://" in u else ""
    host = lower(re.match(r"[^/?#]*", rest)[0])
    path = re.match(r"[^?#]*", rest[len(re.match(r"[^/?#]*", rest)[0]):])[0]
    best = None
    for h, p, v in url_filter.RULES:
        if (host == h or host.endswith("." + h)) and path.startswith(p) and (best is None or len(h + p) > len(best[0])):
            best = (h + p, v)
    words = re.findall(r"[a-z0-9]+", lower(u))
    hard = sum(w in url_filter.STRICT for w in words)
    soft = len({w for w in words if w in url_filter.SOFT})
    return host, path, best and best[0], best[1] if best else "block" if hard or soft >= 2 else "allow", hard, soft


URLS = [None, "", "no scheme", "http://", "https://A.Example.COM/en/x?y#z", "https://example.com/EN/x", "http://www.example.com/en/", "http://wwww.example.com/en/a",
        "http://x.net/fr/casino", "http://x.net/de/casino", "http://casino.net", "http://x.org/free-bets", "http://x.org/free/free", "http://x.org/freebets", "http://com/",
        "http://com", "ftp://user@h.com:80/p", "http://x.org?porn=1", "http://x.org#xxx xxx", "http://a.org/b://c/d", "http://éxample.org/sex", "http://x.org/ésex", "http://x.org/spam_casino", "HTTP://X.ORG/CASINO",
        "http://x.org/" + "a/" * 40_000 + "porn", "http://x.org/a\nb/adult"]


def test_urls_against_brute_force(spark):
    rows = [(k, u, "h", "p", None) for k, u in enumerate(URLS)] + [(None, URLS[4], "h", "p", None)] * 2
    got = url_filter.judge_urls(spark.createDataFrame(rows, "page_id bigint, url string, host string, path string, html string")).collect()
    want = sorted((str(r[0]), *map(str, judged(r[1]))) for r in rows)
    assert sorted((str(r[0]), *map(str, r[1:])) for r in got) == want


def test_urls_empty_table_and_vocabulary(spark):
    empty = spark.createDataFrame([], "page_id bigint, url string")
    assert url_filter.judge_urls(empty).count() == 0
    one = spark.createDataFrame([(1, "http://x.org/casino")], "page_id bigint, url string")
    assert url_filter.judge_urls(one, rules=[], strict=[], soft=[]).first().verdict == "allow"
