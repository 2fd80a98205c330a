"""The registered queries of the operators: (spark, sf_dir) -> DataFrame, and their SQL."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from chanwh.llm import decontaminate, divergence, exact_dedup, html_extract, lexical_search, ngram_join, outliers, packing, sharding, suffix_dedup, token_counts, toxicity, url_filter


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_main_text(table(spark, sf_dir, "pages"))


def op2_digest_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.deduplicate(table(spark, sf_dir, "documents"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages"))


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_texts(table(spark, sf_dir, "documents"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.deduplicate_strings(table(spark, sf_dir, "documents"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_uniform_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_rows(table(spark, sf_dir, "documents"), shards=40)


def pack(docs: DataFrame) -> DataFrame:
    import public_tokenizers

    return packing.pack_documents(docs, tokenizer("byte_bpe_50k.json"), tokenizer("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit_sources(table(spark, sf_dir, "documents"))


def op12_quality_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outliers.judge_quality(table(spark, sf_dir, "documents")).drop("distance", "cell")


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {f.__name__: f for f in (op1_html_text, op2_digest_dedup, op3_url_filter, op4_ngram_join, op5_suffix_dedup, op6_token_counts, op7_toxicity, op8_decontaminate, op9_uniform_shards, op10_packing, op11_divergence, op12_quality_outliers, op13_lexical_search)}

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def term_list(terms: list[str]) -> str:
    return "[" + ", ".join(f"'{t}'" for t in terms) + "]"


OP3_SQL = f"""
with cut as (
  select page_id, coalesce(url, '') as u, instr(coalesce(url, ''), '://') as pos from pages
), parts as (
  select page_id,
    translate(u, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as lu,
    case when pos > 0 then substr(u, pos + 3) else '' end as rest
  from cut
), split as (
  select page_id, lu,
    translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path
  from parts
), rules(h, p, v) as (
  values ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
         ('net', '/es/', 'block'), ('net', '/fr/', 'block')
), fits as (
  select s.page_id, arg_max(r.h || r.p, length(r.h || r.p)) as rule, arg_max(r.v, length(r.h || r.p)) as v
  from split s join rules r on (s.host = r.h or ends_with(s.host, '.' || r.h)) and starts_with(s.path, r.p)
  group by 1
), hits as (
  select page_id, host, path,
    len(list_filter({term_list(url_filter.STRICT)}, lambda t: regexp_matches(lu, '(^|[^a-z0-9])' || t || '([^a-z0-9]|$)'))) as hard,
    cast(len(list_filter({term_list(url_filter.SOFT)}, lambda t: regexp_matches(lu, '(^|[^a-z0-9])' || t || '([^a-z0-9]|$)'))) as int) as soft_terms,
    {{strict_hits}} as strict_hits
  from split
)
select h.page_id, h.host, h.path, f.rule,
  coalesce(f.v, case when h.hard > 0 or h.soft_terms >= 2 then 'block' else 'allow' end) as verdict,
  h.strict_hits, h.soft_terms
from hits h left join fits f using (page_id)
"""
# strict hits are counted with repeats; a lookahead is not needed as terms hold only a-z and the
# boundary may be shared, so each boundary is doubled before counting
OP3_SQL = OP3_SQL.replace("{strict_hits}", "cast(len(regexp_extract_all(regexp_replace(lu, '([^a-z0-9])', '\\1\\1', 'g'), '(^|[^a-z0-9])("
                          + "|".join(url_filter.STRICT) + ")([^a-z0-9]|$)')) as int)")

OP11_SQL = rf"""
with docs as (
  select row_number() over () as row, coalesce(lang, '') as lang, coalesce(source, '') as source,
    regexp_extract_all({LOWER}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as terms from documents
), terms as (select row, lang, source, unnest(terms) as term from docs),
kept as (select lang, term from terms group by all having count(distinct row) >= 3),
kinds as (select lang, count(*) as v from kept group by 1),
counts as (select lang, source, term, count(*) as n from terms semi join kept using (lang, term) group by all),
totals as (
  select g.lang, g.source, coalesce(any_value(k.v), 0) as v, coalesce(sum(c.n), 0) as total
  from (select distinct lang, source from docs) g left join kinds k on k.lang = g.lang
  left join counts c on c.lang = g.lang and c.source = g.source group by all
), shares as (
  select t.lang, t.source, k.term, coalesce(c.n, 0) as n, 1 + (1000000000::hugeint * (coalesce(c.n, 0) + 1)) // (t.total + t.v) as p
  from totals t join kept k using (lang) left join counts c on c.lang = t.lang and c.source = t.source and c.term = k.term
), whole as (
  select lang, term, 1 + (1000000000::hugeint * (sum(n) + 1)) // (any_value(l.total) + any_value(l.v)) as q
  from shares join (select lang, sum(total) as total, any_value(v) as v from totals group by 1) l using (lang) group by all
), pairs as (
  select a.lang, a.source, 'pair' as part, b.source as item, sum((a.p - b.p) * (a.p - b.p) // b.p) as value
  from shares a join shares b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all
  union all
  select a.lang, a.source, 'pair', b.source, 0 from totals a join totals b on a.lang = b.lang and a.source <> b.source where a.v = 0
), preferred as (
  select lang, source, 'term' as part, term as item, (p - q) * (p - q) // q as value
  from shares join whole using (lang, term) where n > 0 and p > q
)
select lang, source, part, item, cast(value as bigint) as value,
  cast(row_number() over (partition by lang, source, part order by value desc, item) as int) as rank
from (select * from pairs union all select * from preferred) qualify part = 'pair' or rank <= 200
"""

OP13_SQL = rf"""
with docs as (
  select row_number() over () as row, doc_id, regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as terms from documents
), sized as (select *, len(terms) as n from docs where len(terms) > 0),
corpus as (select count(*) as big_n, cast(sum(n) as bigint) as big_l from sized),
counts as (select row, term, count(*) as tf from (select row, unnest(terms) as term from sized) group by all),
queries as (
  select distinct item, item_id, term from (
    select item, item_id, unnest(regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
    from (select row_number() over () as item, item_id, text from benchmark))
), weights as (
  select term, cast(floor(1000 * ln((2 * any_value(big_n) + 2) / (2 * count(*) + 1))) as bigint) as w from counts, corpus group by 1
), scores as (
  select q.item, q.item_id, s.doc_id, s.row,
    cast(sum(w.w * ((1000000000 * c.tf) // (1000 * c.tf + 20 * (100 - 50 + (50 * s.n * big_n) // big_l)))) as bigint) as score
  from queries q join weights w using (term) join counts c using (term) join sized s on s.row = c.row, corpus
  group by all
)
select item_id, cast(row_number() over (partition by item order by score desc, doc_id) as int) as rank, doc_id, score
from scores where score > 0 qualify rank <= 50
"""

def op12_sql() -> str:
    """The same estimates, step by step, with the quantiles of chi-square as decimal constants."""
    low, final, c_step, c_final = 11.14328678187778, 18.466826952903048, 1.4864156071332657, 1.0644658582790703
    pairs = [(i, j) for i in range(4) for j in range(i + 1)]
    sums = ", ".join([f"sum(x{i}) as s{i}" for i in range(4)] + [f"sum(x{i} * x{j}) as p{i}{j}" for i, j in pairs])

    def factor(name: str, source: str, variance: str, more: str = "") -> str:
        """Cholesky factors, a lateral column after the other."""
        cols = []
        for i, j in pairs:
            rest = variance.format(i=i, j=j) + (" + 40000" if i == j else "") + "".join(f" - l{i}{k} * l{j}{k}" for k in range(j))
            cols.append(f"sqrt({rest}) as l{i}{j}" if i == j else f"({rest}) / l{j}{j} as l{i}{j}")
        return f"{name} as (select cell, start, {more}{', '.join(cols)}, l00 * l11 * l22 * l33 as det from {source})"

    def means(c: float) -> tuple[str, str]:
        return f"{c!r}::double * (p{{i}}{{j}} / n - m{{i}} * m{{j}})", "".join(f"s{i} / n as m{i}, " for i in range(4))

    def distance(name: str, source: str) -> str:
        ys = []
        for i in range(4):
            ys.append(f"(x{i} - m{i}" + "".join(f" - l{i}{k} * y{k}" for k in range(i)) + f") / l{i}{i} as y{i}")
        return f"{name} as (select r.*, e.start, {', '.join(ys)}, y0 * y0 + y1 * y1 + y2 * y2 + y3 * y3 as d2 from rows r join {source} e on r.cell = e.cell)"

    zero = lambda i, j: f"(1.4826::double * a{i}) ** 2" if i == j else "0"
    medians = lambda c: ", ".join(f"quantile_disc({c.format(i=i)}, 0.5) as {{v}}{i}" for i in range(4))
    steps = []
    for k in range(6):
        v, m = means(c_step)
        steps += [distance(f"near{k}", f"start{k}"),
                  f"bins{k} as (select *, floor(1000 * ln(1 + d2)) as bin from near{k})",
                  f"cuts{k} as (select cell, start, bin, sum(c) over (partition by cell, start order by bin) - c as before, sum(c) over (partition by cell, start) as whole from (select cell, start, bin, count(*) as c from bins{k} group by all))",
                  f"sums{k} as (select cell, start, count(*) as n, {sums} from bins{k} join cuts{k} using (cell, start, bin) where before < ceil(0.75::double * whole) group by all)",
                  factor(f"start{k + 1}", f"sums{k}", v, m)]
    first_v, first_m = means(1.0)
    last_v, last_m = means(c_final)
    spread = " union all ".join([f"select cell, 0 as start, {', '.join(f'v{i}::double as m{i}' for i in range(4))}, {', '.join(f'{zero(i, j)} as c{i}{j}' for i, j in pairs)} from deviations"])
    return rf"""
with texts as (select row_number() over () as row, doc_id, coalesce(lang, '') as lang, coalesce(source, '') as source, coalesce(text, '') as t from documents),
words as (select *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') as w, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines from texts),
windows as (select row, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] as g from (select row, w, unnest(range(1, len(w) - 1)) as i from words)),
repeated as (
  select row, count(distinct p) as n from (
    select row, unnest([i, i + 1, i + 2]) as p from (select *, count(*) over (partition by row, g) as c from windows) where c > 1)
  group by 1
), stats as (
  select row, doc_id, lang, source, len(w) as n_words, cast(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) as bigint) as word_chars,
    len(regexp_extract_all(t, '[#*$%&|<>]')) as n_symbols, len(lines) - len(list_distinct(lines)) as n_dup_lines, coalesce(r.n, 0) as n_repeat_words
  from words left join repeated r using (row)
), judged as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from stats),
groups as (select lang, source, count(*) as n from judged where not base_failed group by all),
pools as (select lang, sum(n) as pool from groups where n < 60 group by 1),
cells as (
  select lang, source, case when n >= 60 then 'g|' || lang || '|' || source when pool >= 60 then 'l|' || lang
    when (select sum(pool) from pools where pool < 60) >= 60 then 'all' end as cell from groups left join pools using (lang)
), rows as (
  select row, cell, cast(floor(1000 * ln(word_chars / n_words) + 0.5) as bigint) as x0, cast(floor(1000 * ln(1 + 10 * n_symbols / (n_words + 100)) + 0.5) as bigint) as x1,
    cast(floor(1000 * ln(1 + 100 * n_dup_lines / (n_words + 100)) + 0.5) as bigint) as x2, cast(floor(1000 * ln(1 + 10 * n_repeat_words / (n_words + 100)) + 0.5) as bigint) as x3
  from judged join cells using (lang, source) where not base_failed and cell is not null
), middles as (select cell, {medians('x{i}').format(v='v')} from rows group by 1),
deviations as (select r.cell, {', '.join(f'any_value(v{i}) as v{i}' for i in range(4))}, {medians('abs(x{i} - v{i})').format(v='a')} from rows r join middles using (cell) group by 1),
robust as ({spread}),
{factor('robust0', 'robust', 'c{i}{j}', ''.join(f'm{i}, ' for i in range(4)))},
everything as (select cell, 1 as start, count(*) as n, {sums} from rows group by 1),
{factor('classical0', 'everything', first_v, first_m)},
start0 as (select * from robust0 union all by name select * from classical0),
{', '.join(steps)},
best as (select * from start6 qualify row_number() over (partition by cell order by det, start) = 1),
{distance('reach', 'best')},
inside as (select cell, 0 as start, count(*) as n, {sums} from reach where d2 <= {low!r} group by all),
{factor('final', 'inside', last_v, last_m)},
{distance('verdicts', 'final')}
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, not base_failed and coalesce(d2, 0) <= {final!r} as kept
from judged left join verdicts using (row)
"""


ORACLE_SQL = {
    "op12_quality_outliers": op12_sql(),
    "op13_lexical_search": OP13_SQL,
    "op11_divergence": OP11_SQL,
    "op2_digest_dedup": f"""
select doc_id, max(doc_id) over (partition by s) as keep_id, count(*) over (partition by s) as group_size,
  doc_id is not distinct from max(doc_id) over (partition by s) and row_number() over (partition by s, doc_id) = 1 as kept,
  s as text_sha256
from (select doc_id, sha256({LOWER}) as s from documents)
""",
    "op3_url_filter": OP3_SQL,
}
