"""Registry of runnable queries (Spark) and their DuckDB oracle SQL, keyed by SURVEY §7.3 names.

Every query reads the driver's whole tables through ``sources.fixtures`` and runs the
library's operators on them as one lazy plan from Parquet; every event, document text and
line item reaches the raw tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chanwh import oracle as O
from chanwh import schemas as S
from chanwh.operators import channels as C
from chanwh.operators import enrich as EN
from chanwh.operators import load as L
from chanwh.operators import profile as P
from chanwh.operators import quality as Q
from chanwh.plans import models as M
from chanwh.plans import reports as R
from chanwh.plans import search_index as SX
from chanwh.sources import coerce as CO
from chanwh.sources import fixtures as FX
from chanwh.sources import lake as LK

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

# Fixed parameters of the registered report queries.
AS_OF = "2024-01-15"
ACTIVITY_CHANNEL = "CheMed"
ACTIVITY_DAYS = 7
SEARCH_QUERY = "ment"
SEARCH_LIMIT = 20
TOP_LIMIT = 10
TOP_MIN_LENGTH = 4

_RAW_BUILDERS = {
    "messages": FX.raw_messages,                 # raw.channel_messages
    "detections": FX.raw_image_detections,       # raw.image_detections
    "messages_dup": FX.raw_messages_dup,         # with re-scraped copies
    "boxes": FX.channel_boxes,                   # box-level detections (inference output contract)
}


def raw_layer(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A raw table as a lazy plan over the whole test tables."""
    return _RAW_BUILDERS[name](spark, sf_dir)


def warehouse(spark: SparkSession, sf_dir: str, detections: bool = False, dup: bool = False) -> M.Warehouse:
    """The star schema as lazy plans over the raw layer. ``detections`` adds the image-detection
    side; ``dup`` builds it over the raw table with re-scraped copies."""
    return M.warehouse(raw_layer(spark, sf_dir, "messages_dup" if dup else "messages"),
                       raw_layer(spark, sf_dir, "detections") if detections else None)


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _after_ctes(sql: str, extra: str, marker: str) -> str:
    return sql.replace("\n" + marker, ",\n" + extra + "\n" + marker, 1)


# ---------------------------------------------------------------------------
# Models
# ---------------------------------------------------------------------------
@register("stg_messages", O.with_ctes("select * from stg_messages", "stg_messages"))
def q_stg_messages(spark, sf_dir):
    return M.stg_messages(raw_layer(spark, sf_dir, "messages"))


@register("stg_detections", O.with_ctes("select * from stg_detections", "stg_detections"))
def q_stg_detections(spark, sf_dir):
    return M.stg_detections(raw_layer(spark, sf_dir, "detections"))


@register("dim_channels", O.with_ctes("select * from dim_channels", "dim_channels"))
def q_dim_channels(spark, sf_dir):
    return M.dim_channels(M.stg_messages(raw_layer(spark, sf_dir, "messages")))


@register("dim_dates", O.with_ctes("select * from dim_dates", "dim_dates"))
def q_dim_dates(spark, sf_dir):
    return M.dim_dates(M.stg_messages(raw_layer(spark, sf_dir, "messages")))


@register("fct_messages", O.with_ctes("select * from fct_messages", "fct_messages"))
def q_fct_messages(spark, sf_dir):
    w = warehouse(spark, sf_dir)
    return M.fct_messages(w.stg_messages, w.dim_channels, w.dim_dates)


@register("fct_image_detections", O.with_ctes("select * from fct_image_detections", "fct_image_detections"))
def q_fct_image_detections(spark, sf_dir):
    w = warehouse(spark, sf_dir, detections=True)
    return M.fct_image_detections(w.stg_detections, w.stg_messages, w.dim_channels, w.dim_dates)


# ---------------------------------------------------------------------------
# N1 top terms
# ---------------------------------------------------------------------------
@register("top_terms", O.with_ctes(f"""
select term, frequency, {O.pct('frequency', 'total')} as percentage
from (select term, count(*) as frequency from {O.terms_cte(TOP_MIN_LENGTH)} k group by term having count(*) >= 2) tc,
     (select sum(frequency) as total from (select term, count(*) as frequency from {O.terms_cte(TOP_MIN_LENGTH)} k
        group by term having count(*) >= 2) x) tt
order by frequency desc, term limit {TOP_LIMIT}""", "fct_messages"))
def q_top_terms(spark, sf_dir):
    return R.top_terms(warehouse(spark, sf_dir).fct_messages, TOP_LIMIT, TOP_MIN_LENGTH)


@register("top_terms_total", O.with_ctes(f"""
select count(*) as total_terms,
  cast(coalesce(sum(case when frequency >= 2 then frequency end), 0) as bigint) as counted_occurrences
from (select term, count(*) as frequency from {O.terms_cte(TOP_MIN_LENGTH)} k group by term) c""", "fct_messages"))
def q_top_terms_total(spark, sf_dir):
    return R.top_terms_total(warehouse(spark, sf_dir).fct_messages, TOP_MIN_LENGTH)


WIDE_LIMIT, WIDE_MIN_LENGTH = 100, 2


@register("top_terms_wide", O.with_ctes(f"""
select term, frequency, {O.pct('frequency', 'total')} as percentage
from (select term, count(*) as frequency from {O.terms_cte(WIDE_MIN_LENGTH)} k group by term having count(*) >= 2) tc,
     (select sum(frequency) as total from (select term, count(*) as frequency from {O.terms_cte(WIDE_MIN_LENGTH)} k
        group by term having count(*) >= 2) x) tt
order by frequency desc, term limit {WIDE_LIMIT}""", "fct_messages"))
def q_top_terms_wide(spark, sf_dir):
    return R.top_terms(warehouse(spark, sf_dir).fct_messages, WIDE_LIMIT, WIDE_MIN_LENGTH)


QUERIES["top_terms_envelope"] = lambda spark, sf_dir: R.top_terms_envelope(
    warehouse(spark, sf_dir).fct_messages, TOP_LIMIT, TOP_MIN_LENGTH)


# ---------------------------------------------------------------------------
# N2 channel activity
# ---------------------------------------------------------------------------
@register("channel_totals", O.with_ctes(f"""
select dc.channel_name, dc.channel_type, s.total_messages, s.total_views, s.avg_views, s.total_forwards,
  dc.first_post_date, dc.last_post_date
from dim_channels dc,
  (select count(*) as total_messages, cast(coalesce(sum(fm.view_count), 0) as bigint) as total_views,
     coalesce({O.mean('sum(fm.view_count)', 'count(*)')}, 0.0) as avg_views,
     cast(coalesce(sum(fm.forward_count), 0) as bigint) as total_forwards
   from fct_messages fm join dim_channels c on fm.channel_key = c.channel_key
   where c.channel_name = {O.q(ACTIVITY_CHANNEL)}) s
where dc.channel_name = {O.q(ACTIVITY_CHANNEL)}""", "fct_messages"))
def q_channel_totals(spark, sf_dir):
    w = warehouse(spark, sf_dir)
    return R.channel_totals(w.fct_messages, w.dim_channels, ACTIVITY_CHANNEL, check=False)


@register("channel_daily", O.with_ctes(f"""
select dd.full_date as activity_date, count(*) as message_count,
  cast(coalesce(sum(fm.view_count), 0) as bigint) as total_views,
  coalesce({O.mean('sum(fm.view_count)', 'count(*)')}, 0.0) as avg_views,
  cast(coalesce(sum(fm.forward_count), 0) as bigint) as total_forwards
from fct_messages fm join dim_channels dc on fm.channel_key = dc.channel_key
  join dim_dates dd on fm.date_key = dd.date_key
where dc.channel_name = {O.q(ACTIVITY_CHANNEL)} and dd.full_date >= date '{AS_OF}' - interval {ACTIVITY_DAYS} day
group by dd.full_date order by dd.full_date desc""", "fct_messages"))
def q_channel_daily(spark, sf_dir):
    w = warehouse(spark, sf_dir)
    return R.channel_daily(w.fct_messages, w.dim_channels, w.dim_dates, ACTIVITY_CHANNEL, ACTIVITY_DAYS, AS_OF, check=False)


@register("channel_daily_short", O.with_ctes(f"""
select dd.full_date as activity_date, count(*) as message_count,
  cast(coalesce(sum(fm.view_count), 0) as bigint) as total_views,
  coalesce({O.mean('sum(fm.view_count)', 'count(*)')}, 0.0) as avg_views,
  cast(coalesce(sum(fm.forward_count), 0) as bigint) as total_forwards
from fct_messages fm join dim_channels dc on fm.channel_key = dc.channel_key
  join dim_dates dd on fm.date_key = dd.date_key
where dc.channel_name = 'Tikvah | Pharma' and dd.full_date >= date '2024-01-10' - interval 3 day
group by dd.full_date order by dd.full_date desc""", "fct_messages"))
def q_channel_daily_short(spark, sf_dir):
    w = warehouse(spark, sf_dir)
    return R.channel_daily(w.fct_messages, w.dim_channels, w.dim_dates, "Tikvah | Pharma", 3, "2024-01-10", check=False)


QUERIES["channel_activity_envelope"] = lambda spark, sf_dir: R.channel_activity_envelope(
    warehouse(spark, sf_dir).fct_messages, warehouse(spark, sf_dir).dim_channels,
    warehouse(spark, sf_dir).dim_dates, ACTIVITY_CHANNEL, ACTIVITY_DAYS, AS_OF, check=False)


# ---------------------------------------------------------------------------
# N3 search
# ---------------------------------------------------------------------------
_LIKE = f"lower(fm.message_text) like lower({O.q('%' + SEARCH_QUERY + '%')}) escape '\\'"


@register("search_messages", O.with_ctes(f"""
select fm.message_id, dc.channel_name, left(fm.message_text, 500) as message_text, fm.message_date,
  fm.view_count, fm.forward_count, fm.has_image, cast(1.0 as double) as relevance_score
from fct_messages fm join dim_channels dc on fm.channel_key = dc.channel_key
where {_LIKE}
order by fm.view_count desc, fm.message_date desc, fm.message_id, dc.channel_name limit {SEARCH_LIMIT}""",
                                         "fct_messages"))
def q_search_messages(spark, sf_dir):
    w = warehouse(spark, sf_dir)
    return R.search_messages(w.fct_messages, w.dim_channels, SEARCH_QUERY, SEARCH_LIMIT)


@register("search_count", O.with_ctes(f"""
select count(*) as total_found from fct_messages fm join dim_channels dc on fm.channel_key = dc.channel_key
where {_LIKE}""", "fct_messages"))
def q_search_count(spark, sf_dir):
    w = warehouse(spark, sf_dir)
    return R.search_count(w.fct_messages, w.dim_channels, SEARCH_QUERY)


SEARCH_CHANNEL = "Tikvah | Pharma"


@register("search_channel", O.with_ctes(f"""
select fm.message_id, dc.channel_name, left(fm.message_text, 500) as message_text, fm.message_date,
  fm.view_count, fm.forward_count, fm.has_image, cast(1.0 as double) as relevance_score
from fct_messages fm join dim_channels dc on fm.channel_key = dc.channel_key
where {_LIKE} and dc.channel_name = {O.q(SEARCH_CHANNEL)}
order by fm.view_count desc, fm.message_date desc, fm.message_id, dc.channel_name limit {SEARCH_LIMIT}""",
                                        "fct_messages"))
def q_search_channel(spark, sf_dir):
    w = warehouse(spark, sf_dir)
    return R.search_messages(w.fct_messages, w.dim_channels, SEARCH_QUERY, SEARCH_LIMIT, channel=SEARCH_CHANNEL)


WILDCARD_QUERY = "qu_e"          # '_' stays a live wildcard, as in the reference
_LIKE_W = f"lower(fm.message_text) like lower({O.q('%' + WILDCARD_QUERY + '%')}) escape '\\'"


@register("search_wildcard_count", O.with_ctes(f"""
select count(*) as total_found from fct_messages fm join dim_channels dc on fm.channel_key = dc.channel_key
where {_LIKE_W}""", "fct_messages"))
def q_search_wildcard_count(spark, sf_dir):
    w = warehouse(spark, sf_dir)
    return R.search_count(w.fct_messages, w.dim_channels, WILDCARD_QUERY)


TRIGRAM_QUERY = "tion_ed ment"      # 'tion', 'ed' and 'ment' between wildcards and spaces: tio ion men ent
_TRIGRAMS = ["ent", "ion", "men", "tio"]


@register("search_trigram_days", O.with_ctes(f"""
select date_key, count(*) as trigrams, count(*) filter (where trigram in {tuple(_TRIGRAMS)}) = {len(_TRIGRAMS)} as candidate
from (select distinct date_key, substr(word, cast(i as int), 3) as trigram
  from (select date_key, word, unnest(range(1, length(word) - 1)) as i
    from (select distinct date_key, unnest(string_split(lower(message_text), ' ')) as word from fct_messages) w
    where length(word) >= 3) p) t
group by date_key""", "fct_messages"))
def q_search_trigram_days(spark, sf_dir):
    """N3's trigram index over whole texts, by day in place of files: the index's size, and which days can hold a match."""
    wanted = SX.query_trigrams(spark, TRIGRAM_QUERY)
    postings = SX.trigram_postings(warehouse(spark, sf_dir).fct_messages, ["date_key"])
    return postings.groupBy("date_key").agg(F.count(F.lit(1)).alias("trigrams"),
                                            (F.count_if(F.col("trigram").isin(wanted)) == len(wanted)).alias("candidate"))


QUERIES["search_envelope"] = lambda spark, sf_dir: R.search_envelope(
    warehouse(spark, sf_dir).fct_messages, warehouse(spark, sf_dir).dim_channels, SEARCH_QUERY, SEARCH_LIMIT)


# ---------------------------------------------------------------------------
# N4 visual content
# ---------------------------------------------------------------------------
def _cat_sql(name: str) -> str:
    return f"cast(sum(case when fid.image_category = {O.q(name)} then 1 else 0 end) as bigint)"


_VISUAL_SQL = f"""
select dc.channel_name, count(*) as total_images,
  {_cat_sql('promotional')} as promotional_count, {_cat_sql('product_display')} as product_display_count,
  {_cat_sql('lifestyle')} as lifestyle_count, {_cat_sql('other')} as other_count,
  {O.mean('sum(fid.total_detections)', 'count(*)')} as avg_detections,
  {O.mean('sum(fid.max_confidence)', 'count(*)')} as avg_confidence,
  {O.mean('sum(fid.view_count)', 'count(*)')} as avg_views
from fct_image_detections fid join dim_channels dc on fid.channel_key = dc.channel_key
group by dc.channel_name"""


@register("visual_by_channel", O.with_ctes(_VISUAL_SQL + " order by total_images desc, channel_name",
                                           "fct_image_detections"))
def q_visual_by_channel(spark, sf_dir):
    w = warehouse(spark, sf_dir, detections=True)
    return R.visual_by_channel(w.fct_image_detections, w.dim_channels)


@register("visual_overall", O.with_ctes(f"""
select cast(coalesce(sum(total_images), 0) as bigint) as total_images, count(*) as total_channels,
  coalesce({O.pct('sum(promotional_count)', 'sum(total_images)')}, 0.0) as overall_promotional_pct,
  coalesce({O.pct('sum(product_display_count)', 'sum(total_images)')}, 0.0) as overall_product_display_pct,
  coalesce({O.pct('sum(lifestyle_count)', 'sum(total_images)')}, 0.0) as overall_lifestyle_pct,
  coalesce({O.pct('sum(other_count)', 'sum(total_images)')}, 0.0) as overall_other_pct
from ({_VISUAL_SQL}) v""", "fct_image_detections"))
def q_visual_overall(spark, sf_dir):
    w = warehouse(spark, sf_dir, detections=True)
    return R.visual_overall(w.fct_image_detections, w.dim_channels)


QUERIES["visual_envelope"] = lambda spark, sf_dir: R.visual_envelope(
    warehouse(spark, sf_dir, detections=True).fct_image_detections, warehouse(spark, sf_dir).dim_channels)


# ---------------------------------------------------------------------------
# A1 / A15 / A16 enrichment
# ---------------------------------------------------------------------------
_ROLLUP_SQL = f"""
select channel_name, message_id, string_agg(class_name, ', ' order by class_name) as detected_classes,
  cast(count(*) as int) as total_detections, round(max(confidence), 4) as max_confidence,
  {O.classify('list_distinct(list(lower(class_name)))')} as image_category
from channel_boxes group by channel_name, message_id"""


@register("box_rollup", O.with_ctes(_ROLLUP_SQL, "channel_boxes"))
def q_box_rollup(spark, sf_dir):
    return EN.rollup_boxes(raw_layer(spark, sf_dir, "boxes"))


@register("rollup_category_breakdown", O.with_ctes(f"""
select image_category, count(*) as count, {O.pct('count(*)', '(select count(*) from r)', 1)} as percentage
from r group by image_category""", "channel_boxes").replace("\nselect image_category", f", r as ({_ROLLUP_SQL})\nselect image_category", 1))
def q_rollup_category_breakdown(spark, sf_dir):
    return EN.category_breakdown(EN.rollup_boxes(raw_layer(spark, sf_dir, "boxes")), digits=1)


@register("class_frequency", _after_ctes(O.with_ctes("""select class_name, count, (select count(*) from cnt) as unique_classes from cnt
order by count desc, class_name limit 10""", "raw_image_detections"), """cnt as (select trim(x) as class_name, count(*) as count
  from (select unnest(string_split(detected_classes, ',')) as x from raw_image_detections
    where detected_classes is not null and detected_classes <> '') s group by trim(x))""",
    "select class_name, count, (select"))
def q_class_frequency(spark, sf_dir):
    return EN.class_frequency(raw_layer(spark, sf_dir, "detections"))


# ---------------------------------------------------------------------------
# Profiles A12-A14, A17
# ---------------------------------------------------------------------------
@register("raw_profile", O.with_ctes("""
select count(*) as total_messages, count(distinct channel_name) as unique_channels,
  min(message_date) as earliest_date, max(message_date) as latest_date from raw_messages""", "raw_messages"))
def q_raw_profile(spark, sf_dir):
    return P.raw_profile(raw_layer(spark, sf_dir, "messages"))


@register("detection_profile", O.with_ctes("""
select count(*) as total_detections, count(distinct channel_name) as unique_channels,
  count(distinct message_id) as unique_messages, count(distinct image_category) as unique_categories
from raw_image_detections""", "raw_image_detections"))
def q_detection_profile(spark, sf_dir):
    return P.detection_profile(raw_layer(spark, sf_dir, "detections"))


@register("category_breakdown", O.with_ctes(f"""
select image_category, count(*) as count,
  {O.pct('count(*)', '(select count(*) from raw_image_detections)', 2)} as percentage
from raw_image_detections group by image_category""", "raw_image_detections"))
def q_category_breakdown(spark, sf_dir):
    return EN.category_breakdown(raw_layer(spark, sf_dir, "detections"), digits=2)


@register("channel_counts", O.with_ctes("""
select channel_name, count(*) as message_count, min(message_date) as first_message, max(message_date) as last_message
from raw_messages_dup group by channel_name""", "raw_messages_dup"))
def q_channel_counts(spark, sf_dir):
    return P.channel_counts(raw_layer(spark, sf_dir, "messages_dup"))


@register("channel_ranking", O.with_ctes("""
select channel_name, count(*) as message_count,
  cast(row_number() over (order by count(*) desc, channel_name nulls first) as int) as place
from raw_messages_dup group by channel_name""", "raw_messages_dup"))
def q_channel_ranking(spark, sf_dir):
    """The order of A17's rows, as a column (one row a channel)."""
    counts = P.channel_counts(raw_layer(spark, sf_dir, "messages_dup"))
    place = F.row_number().over(Window.orderBy(F.desc("message_count"), F.asc_nulls_first("channel_name")))
    return counts.select("channel_name", "message_count", place.alias("place"))


# ---------------------------------------------------------------------------
# Duplicate reports A19-A21
# ---------------------------------------------------------------------------
def _agg_list(c: str) -> str:
    return f"array_to_string(list_sort(list_distinct(list({c}))), ', ')"


@register("dup_mart", O.with_ctes(f"""
select fm.message_id, count(*) as count, {_agg_list('fm.channel_key')} as channel_keys,
  {_agg_list('dc.channel_name')} as channel_names
from fct_messages fm join dim_channels dc on fm.channel_key = dc.channel_key
group by fm.message_id having count(*) > 1""", "fct_messages", raw="raw_messages_dup"))
def q_dup_mart(spark, sf_dir):
    w = warehouse(spark, sf_dir, dup=True)
    return P.dup_mart(w.fct_messages, w.dim_channels)


@register("dup_raw", O.with_ctes("""
select message_id, channel_name, count(*) as count, min(message_date) as first_date, max(message_date) as last_date
from raw_messages_dup group by message_id, channel_name having count(*) > 1
order by count desc, message_id nulls first, channel_name nulls first limit 10""", "raw_messages_dup"))
def q_dup_raw(spark, sf_dir):
    return P.dup_raw(raw_layer(spark, sf_dir, "messages_dup"))


@register("dup_cross_channel", O.with_ctes(f"""
select message_id, count(distinct channel_name) as channel_count, {_agg_list('channel_name')} as channels
from raw_messages_dup where channel_name is not null group by message_id having count(distinct channel_name) > 1
order by channel_count desc, message_id nulls first limit 10""", "raw_messages_dup"))
def q_dup_cross_channel(spark, sf_dir):
    return P.dup_cross_channel(raw_layer(spark, sf_dir, "messages_dup"))


# ---------------------------------------------------------------------------
# Q1-Q9 quality report
# ---------------------------------------------------------------------------
QUALITY_AS_OF = "2024-01-15 12:00:00"


@register("quality_report", O.with_ctes(O.quality_sql(QUALITY_AS_OF), "fct_messages",
                                        "fct_image_detections"))
def q_quality_report(spark, sf_dir):
    w = warehouse(spark, sf_dir, detections=True)
    tables = {"stg_channel_messages": w.stg_messages, "stg_image_detections": w.stg_detections,
              "dim_channels": w.dim_channels, "dim_dates": w.dim_dates,
              "fct_messages": w.fct_messages, "fct_image_detections": w.fct_image_detections}
    return Q.run_checks(tables, as_of=QUALITY_AS_OF)


# ---------------------------------------------------------------------------
# S6 / S7 insert-or-skip
# ---------------------------------------------------------------------------
def _batch_sql(table: str, col: str) -> str:
    return (f"target as (select * from {table} where {col} < timestamp '2024-01-08' or {col} is null),\n"
            f"batch as (select *, 0 as batch_seq from {table} where {col} >= timestamp '2024-01-05' or {col} is null\n"
            f"  union all select *, 1 as batch_seq from {table} where {col} >= timestamp '2024-01-12' or {col} is null),\n")


_INSERT_SQL = O.with_ctes("""
d as (select * exclude (rn) from (select *, row_number() over (partition by message_id, channel_name, message_date
   order by batch_seq) as rn from batch) b where rn = 1 or message_id is null or channel_name is null or message_date is null)
select * exclude (batch_seq) from d where not exists (select 1 from target t where t.message_id = d.message_id
  and t.channel_name = d.channel_name and t.message_date = d.message_date)""", "raw_messages")
_INSERT_SQL = _INSERT_SQL.replace("\nd as (", ",\n" + _batch_sql("raw_messages", "message_date") + "d as (", 1)


@register("insert_or_skip", _INSERT_SQL)
def q_insert_or_skip(spark, sf_dir):
    target, batch = FX.insert_scenario(raw_layer(spark, sf_dir, "messages"))
    return L.insert_or_skip(target, batch, ["message_id", "channel_name", "message_date"], ["batch_seq"])


_INSERT_DET_SQL = O.with_ctes("""
d as (select * exclude (rn) from (select *, row_number() over (partition by message_id, channel_name
   order by batch_seq) as rn from batch where message_id is not null and channel_name is not null) b where rn = 1)
select * exclude (batch_seq) from d where not exists (select 1 from target t where t.message_id = d.message_id
  and t.channel_name = d.channel_name)""", "raw_image_detections")
_INSERT_DET_SQL = _INSERT_DET_SQL.replace(
    "\nd as (", ",\n" + _batch_sql("raw_image_detections", "processed_at") + "d as (", 1)


@register("insert_detections", _INSERT_DET_SQL)
def q_insert_detections(spark, sf_dir):
    target, batch = FX.detection_insert_scenario(raw_layer(spark, sf_dir, "detections"))
    return L.insert_or_skip(target, batch, ["message_id", "channel_name"], ["batch_seq"], reject_null_keys=True)


# ---------------------------------------------------------------------------
# Channels: J10-J12, P13, W1, A22, A23
# ---------------------------------------------------------------------------
QUOTA_CAPS = {"CheMed123": (40, 10), "lobelia4cosmetics": (None, 25), "tikvahpharma": (0, 5)}


def _config_sql(caps) -> str:
    rows = []
    for ch, pat, order in O.CONFIG_CHANNELS:
        mm, mi = caps.get(ch, (None, None))
        rows.append((ch, pat, order, mi if mi is not None else O.DEFAULT_MAX_IMAGES, mm))
    return O.values_sql(rows, "channel, pattern, pattern_order, max_images, max_messages")


def _resolved_sql(caps, names_from: str = "raw_messages") -> str:
    return f"""config as {_config_sql(caps)},
names as (select distinct channel_name from {names_from} where channel_name is not null),
best as (select n.channel_name, arg_min({{'c': c.channel, 'mi': c.max_images, 'mm': c.max_messages}},
    case when n.channel_name = c.channel then 1 when lower(n.channel_name) = lower(c.channel) then 2
         else 10 + c.pattern_order end) as cfg
  from names n join config c on n.channel_name = c.channel or lower(n.channel_name) = lower(c.channel)
    or contains(regexp_replace(lower(n.channel_name), '[ _-]', '', 'g'), c.pattern)
  group by n.channel_name),
resolved as (select n.channel_name, coalesce(b.cfg.c, n.channel_name) as config_channel,
  coalesce(b.cfg.mi, {O.DEFAULT_MAX_IMAGES}) as max_images, b.cfg.mm as max_messages, b.cfg is not null as matched
  from names n left join best b on n.channel_name = b.channel_name)"""


@register("resolve_channel", _after_ctes(O.with_ctes("select * from resolved", "raw_messages"),
                                         _resolved_sql({}), "select * from resolved"))
def q_resolve_channel(spark, sf_dir):
    names = C.distinct_names(raw_layer(spark, sf_dir, "messages"))
    return C.resolve_channels(names, FX.channel_config(spark))


_QUOTA_FINAL = """select message_id, channel_name, config_channel, message_date, has_photo,
  has_photo and coalesce(new_before, 0) < max_images - coalesce(held, 0) as image_downloaded from p"""
_QUOTA_EXTRA = _resolved_sql(QUOTA_CAPS) + """,
quota_messages as (select * from raw_messages
  union all select message_id, 'CheMed123', message_date, message_text, has_media, image_path, views, forwards, is_reply,
    reply_to_msg_id, scraped_at, loaded_at from raw_messages where channel_name = 'CheMed' and message_id % 2 = 0
  union all select message_id, null, message_date, message_text, has_media, image_path, views, forwards, is_reply,
    reply_to_msg_id, scraped_at, loaded_at from raw_messages where channel_name = ' Beauty Hub '),
stored as (select distinct channel_name, message_id from raw_messages where image_path <> '' and message_id % 4 = 0 and message_id >= 200),
m as (select r.message_id, r.channel_name, r.message_date, coalesce(v.config_channel, r.channel_name) as config_channel,
  v.max_messages, coalesce(v.max_images, 1500) as max_images,
  coalesce(r.image_path is not null and r.image_path <> '', false) as has_photo
  from quota_messages r left join resolved v on r.channel_name = v.channel_name),
k as (select *, row_number() over (partition by config_channel order by message_date desc nulls last, message_id desc,
  channel_name nulls first) as rn from m),
kept as (select k.*, h.held, has_photo and not exists (select 1 from stored s where s.message_id = k.message_id
    and s.channel_name is not distinct from k.channel_name) as is_new
  from k left join (select coalesce(v.config_channel, s.channel_name) as cc, count(*) as held
    from stored s left join resolved v on s.channel_name = v.channel_name group by 1) h on h.cc is not distinct from k.config_channel
  where max_messages is null or rn <= max_messages),
p as (select *, sum(case when is_new then 1 else 0 end) over (partition by config_channel
  order by message_date desc nulls last, message_id desc, channel_name nulls first
  rows between unbounded preceding and 1 preceding) as new_before from kept)"""


@register("quota", _after_ctes(O.with_ctes(_QUOTA_FINAL, "raw_messages"), _QUOTA_EXTRA.replace(
    "names as (select distinct channel_name from raw_messages where channel_name is not null)",
    "names as (select distinct channel_name from raw_messages where channel_name is not null union select 'CheMed123')"),
    _QUOTA_FINAL.split("\n")[0]))
def q_quota(spark, sf_dir):
    """W1 over all messages, copies of some under a second display name of the same channel (equal
    dates and ids) and copies without a channel; some images are stored already."""
    raw = raw_layer(spark, sf_dir, "messages")
    own = F.col("channel_name")
    names = F.array(F.struct(own.alias("n")), F.when((own == "CheMed") & (F.col("message_id") % 2 == 0), F.struct(F.lit("CheMed123").alias("n"))),
                    F.when(own == " Beauty Hub ", F.struct(F.lit(None).cast("string").alias("n"))))
    copies = raw.withColumn("_copy", F.explode(F.filter(names, lambda c: c.isNotNull())))
    messages = copies.withColumn("channel_name", F.col("_copy.n")).drop("_copy")
    stored = raw.where((F.col("image_path") != "") & (F.col("message_id") % 4 == 0) & (F.col("message_id") >= 200)).select("channel_name", "message_id")
    resolved = C.resolve_channels(C.distinct_names(messages), FX.channel_config(spark, QUOTA_CAPS))
    q = C.apply_quota(messages, resolved, stored)
    return q.select("message_id", "channel_name", "config_channel", "message_date", "has_photo", "image_downloaded")


_EXPECTED_ROWS = [(ch, v) for ch, vs in O.EXPECTED_CHANNELS for v in vs]


def _found(names: str) -> str:
    return (f"exists (select 1 from expected v, {names} l where v.expected_channel = x.expected_channel and "
            f"(contains(lower(l.channel_name), lower(v.variant)) or contains(lower(v.variant), lower(l.channel_name))))")


_EXPECTED_FINAL = f"""select x.expected_channel, {_found('lake')} as found_in_lake, {_found('tab')} as found_in_table
from (select distinct expected_channel from expected) x"""


@register("expected_channels", _after_ctes(O.with_ctes(_EXPECTED_FINAL, "stg_messages"), f"""expected as {O.values_sql(_EXPECTED_ROWS, 'expected_channel, variant')},
lake as (select distinct channel_name from raw_messages where channel_name is not null),
tab as (select distinct channel_name from stg_messages)""", _EXPECTED_FINAL.split("\n")[0]))
def q_expected_channels(spark, sf_dir):
    raw = raw_layer(spark, sf_dir, "messages")
    stg = M.stg_messages(raw)
    return C.expected_presence(C.distinct_names(raw), C.distinct_names(stg), FX.expected_channels(spark))


@register("reconcile", O.with_ctes("""
select coalesce(a.channel_name, b.channel_name) as channel_name, coalesce(a.lake_count, 0) as lake_count,
  coalesce(b.table_count, 0) as table_count,
  case when a.lake_count is null then 'missing_in_lake' when b.table_count is null then 'missing_in_table' else 'ok' end
    as status
from (select channel_name, count(*) as lake_count from raw_messages group by channel_name) a
full outer join (select channel_name, count(*) as table_count from stg_messages group by channel_name) b
  on a.channel_name = b.channel_name""", "stg_messages"))
def q_reconcile(spark, sf_dir):
    raw = raw_layer(spark, sf_dir, "messages")
    return C.reconcile(raw, M.stg_messages(raw))


@register("reconcile_summary", O.with_ctes("""
select count(*) filter (where lake_count > 0) as lake_channels, cast(coalesce(sum(lake_count), 0) as bigint) as lake_messages,
  count(*) filter (where table_count > 0) as table_channels, cast(coalesce(sum(table_count), 0) as bigint) as table_messages
from (select coalesce(a.lake_count, 0) as lake_count, coalesce(b.table_count, 0) as table_count
  from (select channel_name, count(*) as lake_count from raw_messages group by channel_name) a
  full outer join (select channel_name, count(*) as table_count from stg_messages group by channel_name) b
  on a.channel_name = b.channel_name) r""", "stg_messages"))
def q_reconcile_summary(spark, sf_dir):
    raw = raw_layer(spark, sf_dir, "messages")
    return C.reconcile_summary(C.reconcile(raw, M.stg_messages(raw)))


@register("valid_usernames", O.with_ctes(r"""
select channel_name, coalesce(regexp_full_match(regexp_replace(channel_name, '^@+', ''), '[\p{L}\p{N}_]{5,}'), false)
  as valid from (select distinct channel_name from raw_messages where channel_name is not null) n""", "raw_messages"))
def q_valid_usernames(spark, sf_dir):
    return C.valid_usernames(C.distinct_names(raw_layer(spark, sf_dir, "messages")))


_LAYERS = [("raw", "channel_messages", "raw_messages"), ("raw", "image_detections", "raw_image_detections"),
           ("staging", "stg_channel_messages", "stg_messages"), ("staging", "stg_image_detections", "stg_detections"),
           ("marts", "dim_channels", "dim_channels"), ("marts", "dim_dates", "dim_dates"),
           ("marts", "fct_messages", "fct_messages"), ("marts", "fct_image_detections", "fct_image_detections")]


@register("layer_counts", O.with_ctes("\nunion all ".join(
    f"select {O.q(layer)} as layer, {O.q(name)} as table_name, 'present' as status, count(*) as row_count from {cte}"
    for layer, name, cte in _LAYERS) + "\nunion all select 'raw', 'scrape_log', 'missing', null", "fct_messages", "fct_image_detections"))
def q_layer_counts(spark, sf_dir):
    w = warehouse(spark, sf_dir, detections=True)
    dfs = {"raw_messages": raw_layer(spark, sf_dir, "messages"), "raw_image_detections": raw_layer(spark, sf_dir, "detections"),
           "stg_messages": w.stg_messages, "stg_detections": w.stg_detections, "dim_channels": w.dim_channels,
           "dim_dates": w.dim_dates, "fct_messages": w.fct_messages, "fct_image_detections": w.fct_image_detections}
    return P.layer_counts({(layer, name): dfs[cte] for layer, name, cte in _LAYERS} | {("raw", "scrape_log"): None})


_SUMMARY_FINAL = """select * from per_channel
union all select null, count(*), (select count(distinct day) from filed), sum(total_messages), sum(images_posted), sum(max_images),
  sum(images_within_cap) from per_channel"""
_SUMMARY_EXTRA = f"""
filed as (select coalesce(v.config_channel, r.channel_name) as config_channel,
    coalesce(cast(r.message_date as date), date '{AS_OF}') as day, coalesce(r.image_path <> '', false) as img, v.max_images
  from raw_messages r left join resolved v on r.channel_name = v.channel_name where r.channel_name is not null),
per_channel as (select config_channel, cast(1 as bigint) as channels, count(distinct day) as total_dates, count(*) as total_messages,
    count(*) filter (where img) as images_posted, cast(max(max_images) as bigint) as max_images,
    least(count(*) filter (where img), cast(max(max_images) as bigint)) as images_within_cap
  from filed group by config_channel)"""


@register("ingest_summary", _after_ctes(O.with_ctes(_SUMMARY_FINAL, "raw_messages"), _resolved_sql({}) + "," + _SUMMARY_EXTRA,
                                        _SUMMARY_FINAL.split("\n")[0]))
def q_ingest_summary(spark, sf_dir):
    raw = raw_layer(spark, sf_dir, "messages")
    resolved = C.resolve_channels(C.distinct_names(raw), FX.channel_config(spark))
    return P.ingest_summary(raw, resolved, as_of=AS_OF)


# ---------------------------------------------------------------------------
# S3 coercion round trip, S10 image-path keys
# ---------------------------------------------------------------------------
@register("coerce_roundtrip", O.with_ctes("""
select message_id, channel_name, message_date, message_text, has_media, image_path, views, forwards,
  is_reply, reply_to_msg_id, scraped_at from raw_messages""", "raw_messages"))
def q_coerce_roundtrip(spark, sf_dir):
    """The raw table written out as lake text and coerced back (S3): must give the table again."""
    return CO.coerce_messages(FX.lake_strings(raw_layer(spark, sf_dir, "messages"))).drop("loaded_at")


_IMG_RE = O.IMAGE_PATH_RE


@register("image_keys", O.with_ctes(f"""
select image_path as path, regexp_extract(image_path, '{_IMG_RE}', 1) as channel_name,
  cast(regexp_extract(image_path, '{_IMG_RE}', 2) as bigint) as message_id
from raw_messages where regexp_extract(image_path, '{_IMG_RE}', 1) <> ''""", "raw_messages"))
def q_image_keys(spark, sf_dir):
    """S10 over every image path of the raw table."""
    return LK.parse_image_path(raw_layer(spark, sf_dir, "messages").select(F.col("image_path").alias("path")))


SCRAPED_AT = "2024-02-01 12:00:00"


def _iso_sql(c: str, utc: bool) -> str:
    base = f"strftime({c}, '%Y-%m-%dT%H:%M:%S')"
    t = f"(case when strftime({c}, '%f') = '000000' then {base} else {base} || '.' || strftime({c}, '%f') end)"
    return f"({t} || '+00:00')" if utc else t


@register("shape_records", O.with_ctes(f"""
select message_id, channel_name, {_iso_sql('message_date', True)} as message_date,
  coalesce(message_text, '') as message_text, has_media as has_media,
  case when has_media and coalesce(image_path <> '', false)
       then 'data/raw/images/' || channel_name || '/' || cast(message_id as varchar) || '.jpg' end as image_path,
  coalesce(views, 0) as views, coalesce(forwards, 0) as forwards, coalesce(is_reply, false) as is_reply,
  case when coalesce(is_reply, false) then reply_to_msg_id end as reply_to_msg_id,
  {_iso_sql(f"timestamp '{SCRAPED_AT}'", False)} as scraped_at
from raw_messages""", "raw_messages"))
def q_shape_records(spark, sf_dir):
    """S12 over every message of the raw table seen as API objects."""
    import datetime as dt
    api = FX.api_messages(raw_layer(spark, sf_dir, "messages"))
    return L.shape_message_records(api, scraped_at=dt.datetime.fromisoformat(SCRAPED_AT))


@register("lake_layout", O.with_ctes(r"""
select strftime(coalesce(cast(message_date as date), date '2024-02-01'), '%Y-%m-%d') as dt,
  replace(trim(regexp_replace(channel_name, '[^\p{L}\p{N} _-]', '', 'g')), ' ', '_') as channel,
  count(*) as message_count
from raw_messages group by all""", "raw_messages"))
def q_lake_layout(spark, sf_dir):
    """S8's partition keys (message day, file-safe channel) over the raw table, with counts."""
    recs = FX.lake_strings(raw_layer(spark, sf_dir, "messages"))
    return recs.select(*L.lake_partition(as_of="2024-02-01")).groupBy("dt", "channel").agg(
        F.count(F.lit(1)).alias("message_count"))


_SAFE_NAME = r"replace(trim(regexp_replace(channel_name, '[^\p{L}\p{N} _-]', '', 'g')), ' ', '_')"


@register("lake_merge", O.with_ctes(f"""
select message_id, dt, channel, message_text from (
  select message_id, strftime(coalesce(cast(message_date as date), date '2024-02-01'), '%Y-%m-%d') as dt, {_SAFE_NAME} as channel, message_text,
    message_date from raw_messages_dup) b
where (message_date >= timestamp '2024-01-05' or message_date is null) and not exists (
  select 1 from raw_messages s where (s.message_date < timestamp '2024-01-08' or s.message_date is null) and s.message_id = b.message_id
    and strftime(coalesce(cast(s.message_date as date), date '2024-02-01'), '%Y-%m-%d') = b.dt
    and {_SAFE_NAME.replace('channel_name', 's.channel_name')} = b.channel)""", "raw_messages", "raw_messages_dup"))
def q_lake_merge(spark, sf_dir):
    """S8's merge: what a batch (all from Jan 5, with re-dated copies) adds to a lake that holds all before Jan 8; rows without a
    date, filed under the day of the load, are in both."""
    day, undated = F.col("message_date"), F.col("message_date").isNull()
    filed = lambda r: FX.lake_strings(r).select(F.col("message_id").try_cast("double").cast("bigint").alias("message_id"), "message_text", *L.lake_partition(as_of="2024-02-01"))
    stored = filed(raw_layer(spark, sf_dir, "messages").where((day < F.lit("2024-01-08").cast("timestamp_ntz")) | undated))
    batch = filed(raw_layer(spark, sf_dir, "messages_dup").where((day >= F.lit("2024-01-05").cast("timestamp_ntz")) | undated))
    return L.lake_additions(batch, stored.select("dt", "channel", F.col("message_id").cast("string").alias("id")))


@register("lake_channel_counts", O.with_ctes("""
select channel_name, count(*) as message_count from raw_messages where channel_name is not null
group by channel_name""", "raw_messages"))
def q_lake_channel_counts(spark, sf_dir):
    """A18 over the raw table rendered as lake records (what S1 yields for it)."""
    return P.lake_channel_counts(FX.lake_strings(raw_layer(spark, sf_dir, "messages")))


@register("images_per_channel", O.with_ctes(f"""
select regexp_extract(image_path, '{_IMG_RE}', 1) as channel_name, count(*) as existing
from raw_messages where regexp_extract(image_path, '{_IMG_RE}', 1) <> ''
group by regexp_extract(image_path, '{_IMG_RE}', 1)""", "raw_messages"))
def q_images_per_channel(spark, sf_dir):
    """S9's per-folder image count over every image path of the raw table."""
    return LK.images_per_channel(raw_layer(spark, sf_dir, "messages").select(F.col("image_path").alias("path")))


# ---------------------------------------------------------------------------
# The nested responses, row by row: what each envelope holds, in its order
# ---------------------------------------------------------------------------
def _entries(df: DataFrame, array: str) -> DataFrame:
    """One row per entry of an envelope's array, with its place and the envelope's own columns."""
    own = [c for c in df.columns if c != array]
    return df.select(*own, F.posexplode(array).alias("place", "_e")).select(*own, "place", "_e.*")


_TOTAL_TERMS = f"(select count(distinct term) from {O.terms_cte(TOP_MIN_LENGTH)} d)"


@register("top_terms_envelope_rows", O.with_ctes(f"""
select cast({TOP_LIMIT} as int) as "limit", {_TOTAL_TERMS} as total_terms,
  cast(row_number() over (order by frequency desc, term) - 1 as int) as place, term, frequency, percentage
from (select term, frequency, {O.pct('frequency', 'total')} as percentage
  from (select term, count(*) as frequency from {O.terms_cte(TOP_MIN_LENGTH)} k group by term having count(*) >= 2) tc,
       (select sum(frequency) as total from (select term, count(*) as frequency from {O.terms_cte(TOP_MIN_LENGTH)} k
          group by term having count(*) >= 2) x) tt
  order by frequency desc, term limit {TOP_LIMIT}) r""", "fct_messages"))
def q_top_terms_envelope_rows(spark, sf_dir):
    return _entries(QUERIES["top_terms_envelope"](spark, sf_dir), "products")


@register("channel_activity_envelope_rows", O.with_ctes(f"""
select t.*, cast(row_number() over (order by d.activity_date desc) - 1 as int) as place, d.activity_date, d.message_count,
  d.total_views as day_views, d.avg_views as day_avg_views, d.total_forwards as day_forwards
from (select dc.channel_name, dc.channel_type, s.total_messages, s.total_views, s.avg_views, s.total_forwards,
    dc.first_post_date, dc.last_post_date
  from dim_channels dc,
    (select count(*) as total_messages, cast(coalesce(sum(fm.view_count), 0) as bigint) as total_views,
       coalesce({O.mean('sum(fm.view_count)', 'count(*)')}, 0.0) as avg_views,
       cast(coalesce(sum(fm.forward_count), 0) as bigint) as total_forwards
     from fct_messages fm join dim_channels c on fm.channel_key = c.channel_key
     where c.channel_name = {O.q(ACTIVITY_CHANNEL)}) s
  where dc.channel_name = {O.q(ACTIVITY_CHANNEL)}) t,
 (select dd.full_date as activity_date, count(*) as message_count,
    cast(coalesce(sum(fm.view_count), 0) as bigint) as total_views,
    coalesce({O.mean('sum(fm.view_count)', 'count(*)')}, 0.0) as avg_views,
    cast(coalesce(sum(fm.forward_count), 0) as bigint) as total_forwards
  from fct_messages fm join dim_channels dc on fm.channel_key = dc.channel_key
    join dim_dates dd on fm.date_key = dd.date_key
  where dc.channel_name = {O.q(ACTIVITY_CHANNEL)} and dd.full_date >= date '{AS_OF}' - interval {ACTIVITY_DAYS} day
  group by dd.full_date) d""", "fct_messages"))
def q_channel_activity_envelope_rows(spark, sf_dir):
    env = QUERIES["channel_activity_envelope"](spark, sf_dir)
    names = {"total_views": "day_views", "avg_views": "day_avg_views", "total_forwards": "day_forwards"}
    entry = F.transform("daily_activity", lambda e: F.struct(
        *[e[c].alias(names.get(c, c)) for c in ("activity_date", "message_count", "total_views", "avg_views", "total_forwards")]))
    return _entries(env.withColumn("daily_activity", entry), "daily_activity")


@register("search_envelope_rows", O.with_ctes(f"""
select {O.q(SEARCH_QUERY)} as query, cast({SEARCH_LIMIT} as int) as "limit", (select count(*) from fct_messages fm
    join dim_channels dc on fm.channel_key = dc.channel_key where {_LIKE}) as total_found,
  cast(row_number() over (order by view_count desc, message_date desc, message_id, channel_name) - 1 as int) as place, r.*
from (select fm.message_id, dc.channel_name, left(fm.message_text, 500) as message_text, fm.message_date,
    fm.view_count, fm.forward_count, fm.has_image, cast(1.0 as double) as relevance_score
  from fct_messages fm join dim_channels dc on fm.channel_key = dc.channel_key
  where {_LIKE}
  order by fm.view_count desc, fm.message_date desc, fm.message_id, dc.channel_name limit {SEARCH_LIMIT}) r""", "fct_messages"))
def q_search_envelope_rows(spark, sf_dir):
    return _entries(QUERIES["search_envelope"](spark, sf_dir), "results")


@register("visual_envelope_rows", O.with_ctes(f"""
select o.*, cast(row_number() over (order by v.total_images desc, v.channel_name) - 1 as int) as place, v.channel_name,
  v.total_images as images, v.promotional_count, v.product_display_count, v.lifestyle_count, v.other_count, v.avg_detections,
  v.avg_confidence, v.avg_views
from ({_VISUAL_SQL}) v, (select cast(coalesce(sum(total_images), 0) as bigint) as total_images, count(*) as total_channels,
  coalesce({O.pct('sum(promotional_count)', 'sum(total_images)')}, 0.0) as overall_promotional_pct,
  coalesce({O.pct('sum(product_display_count)', 'sum(total_images)')}, 0.0) as overall_product_display_pct,
  coalesce({O.pct('sum(lifestyle_count)', 'sum(total_images)')}, 0.0) as overall_lifestyle_pct,
  coalesce({O.pct('sum(other_count)', 'sum(total_images)')}, 0.0) as overall_other_pct
  from ({_VISUAL_SQL}) x) o""", "fct_image_detections"))
def q_visual_envelope_rows(spark, sf_dir):
    env = QUERIES["visual_envelope"](spark, sf_dir)
    fields = env.schema["channels"].dataType.elementType.names
    entry = F.transform("channels", lambda e: F.struct(*[e[c].alias("images" if c == "total_images" else c) for c in fields]))
    return _entries(env.withColumn("channels", entry), "channels")


# ---------------------------------------------------------------------------
# S1 and S4 without folders: files as text rows, detections as strings
# ---------------------------------------------------------------------------
@register("lake_parse", O.with_ctes("""
select message_id, channel_name, message_date, message_text, has_media, image_path, views, forwards,
  is_reply, reply_to_msg_id, scraped_at from raw_messages""", "raw_messages"))
def q_lake_parse(spark, sf_dir):
    """S1's parser over one file per message: single objects, and arrays with an element that is no
    object; truncated copies of every fifth file are skipped as a whole."""
    strings = FX.lake_strings(raw_layer(spark, sf_dir, "messages"))
    obj = F.to_json(F.struct(*strings.columns))
    even = F.col("message_id").endswith(".0")
    files = strings.select(F.when(even, F.concat(F.lit("[7, "), obj, F.lit("]"))).otherwise(obj).alias("value"), F.col("message_id").alias("_file"))
    broken = files.where(F.col("_file").endswith("5")).select(F.substr("value", F.lit(1), F.length("value") - 3).alias("value"), "_file")
    return CO.coerce_messages(LK.parse_lake_text(files.unionByName(broken))).drop("loaded_at", "_file", "_pos")


@register("lake_parse_counts", O.with_ctes("""
select channel_name, count(*) as message_count from raw_messages where channel_name is not null
group by channel_name""", "raw_messages"))
def q_lake_parse_counts(spark, sf_dir):
    """A18 on records that S1's parser read."""
    strings = FX.lake_strings(raw_layer(spark, sf_dir, "messages"))
    files = strings.select(F.to_json(F.struct("message_id", "channel_name")).alias("value"), F.col("message_id").alias("_file"))
    return P.lake_channel_counts(LK.parse_lake_text(files))


@register("detection_csv", O.with_ctes("""
select message_id, channel_name, image_path, detected_classes, coalesce(total_detections, 0) as total_detections, max_confidence,
  image_category, processed_at from raw_image_detections""", "raw_image_detections"))
def q_detection_csv(spark, sf_dir):
    """S2 and S4 over every detection row as a line of CSV: must give the table again, a missing total as 0."""
    det = raw_layer(spark, sf_dir, "detections")
    lines = det.select(F.to_csv(F.struct(*[F.col(c).cast("string").alias(c) for c in S.DETECTION_CSV_FIELDS]), L.CSV_KEEPS_SPACES).alias("value"))
    return CO.coerce_detections(LK.parse_detection_lines(lines)).drop("loaded_at")


@register("coerce_detections", O.with_ctes("""
select message_id, channel_name, image_path, detected_classes, coalesce(total_detections, 0) as total_detections, max_confidence,
  image_category, processed_at from raw_image_detections
union all select null, channel_name, image_path, detected_classes, 0, null, image_category, null from raw_image_detections
  where message_id % 10 = 0""", "raw_image_detections"))
def q_coerce_detections(spark, sf_dir):
    """S4 over every detection row as text, and over copies of some with numbers and dates that are none."""
    det = raw_layer(spark, sf_dir, "detections").drop("loaded_at")
    text = det.select(*[F.col(c).cast("string").alias(c) for c in det.columns])
    bad = (text.where(F.col("message_id").cast("bigint") % 10 == 0)
           .withColumns({"message_id": F.lit("x1"), "total_detections": F.lit("many"), "max_confidence": F.lit("n/a"), "processed_at": F.lit("yesterday")}))
    return CO.coerce_detections(text.unionByName(bad)).drop("loaded_at")
