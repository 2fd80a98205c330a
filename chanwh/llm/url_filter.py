"""URL verdicts: host and path rules first, then a weighted vocabulary.

Vocabulary terms are counted in one pass over the URL by an Aho-Corasick automaton, whatever the
size of the vocabulary; a hit counts only between characters that are not a-z or 0-9. One strict
term, or at least ``soft_limit`` different soft ones, reject the URL.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chanwh.llm.shared import ascii_lower

#: The rules of the query, (host, path, verdict).
RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("net", "/fr/", "block")]
#: The vocabulary is a parameter; these terms are the default.
STRICT = ["adult", "casino", "hentai", "malware", "nsfw", "phishing", "porn", "porno", "sex", "spam", "viagra", "warez", "xxx"]
SOFT = ["ad", "ads", "bet", "bets", "bonus", "cheap", "clickbait", "crack", "discount", "farm", "free", "loan", "loans", "lottery",
        "pill", "pills", "poker", "popup", "prize", "replica", "slots", "track", "tracker", "win", "winner"]
SOFT_LIMIT = 2


def host_and_path(url: str) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; path:
    from there up to ``?``, ``#`` or the end. Both empty for a null URL or one without ``://``."""
    u = F.coalesce(F.col(url).cast("string"), F.lit(""))
    at = F.instr(u, "://")
    rest = F.when(at > 0, F.substr(u, at + 3)).otherwise(F.lit(""))
    return ascii_lower(F.regexp_extract(rest, r"^[^/?#]*", 0)), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def longest_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The longest rule (as written: host and path) that fits, and its verdict; null if none does.
    Of equally long rules the first of the list wins."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: -len(r[0] + r[1]))[::-1]:
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name, verdict = F.when(fits, F.lit(h + p)).otherwise(name), F.when(fits, F.lit(v)).otherwise(verdict)
    return name, verdict


def term_counter(strict: list[str], soft: list[str]):
    """A pandas UDF: (strict hits, different soft terms) of each URL."""

    @F.pandas_udf("strict_hits int, soft_terms int")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        import ahocorasick

        automaton = ahocorasick.Automaton()
        for kind, terms in ((1, soft), (0, strict)):  # a term in both lists is strict
            for term in terms:
                automaton.add_word(term, (kind, term))
        automaton.add_word("\0", (1, "\0"))  # never counted: an automaton needs a word
        automaton.make_automaton()
        inside = set("abcdefghijklmnopqrstuvwxyz0123456789")

        def hits(url: str) -> tuple[int, int]:
            hard, seen = 0, set()
            for end, (kind, term) in automaton.iter(url):
                if term == "\0":
                    continue
                start = end - len(term)
                if (start < 0 or url[start] not in inside) and (end + 1 == len(url) or url[end + 1] not in inside):
                    if kind:
                        seen.add(term)
                    else:
                        hard += 1
            return hard, len(seen)

        for urls in batches:
            yield pd.DataFrame([hits(u) for u in urls], columns=["strict_hits", "soft_terms"])

    return count


def judge_urls(pages: DataFrame, rules=RULES, strict=STRICT, soft=SOFT, soft_limit: int = SOFT_LIMIT,
               id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per row of ``pages``: id, ``host``, ``path``, ``rule`` (the longest that fits, or
    null), ``verdict`` (the rule's, else the vocabulary's), ``strict_hits``, ``soft_terms``.

    A null or empty URL has no host, fits no rule and is allowed. Rules and vocabulary are short
    lists that travel inside the plan; each row is judged on its own, so nothing is shuffled.
    """
    host, path = host_and_path(url_col)
    url = ascii_lower(F.coalesce(F.col(url_col).cast("string"), F.lit("")))
    rows = pages.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path"), term_counter(strict, soft)(url).alias("hits"))
    rule, verdict = longest_rule(F.col("host"), F.col("path"), rules)
    by_terms = F.when((F.col("hits.strict_hits") > 0) | (F.col("hits.soft_terms") >= soft_limit), F.lit("block")).otherwise(F.lit("allow"))
    return rows.select(F.col("id").alias(id_col), "host", "path", rule.alias("rule"), F.coalesce(verdict, by_terms).alias("verdict"),
                       F.col("hits.strict_hits").alias("strict_hits"), F.col("hits.soft_terms").alias("soft_terms"))
