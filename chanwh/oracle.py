"""DuckDB SQL for the correctness oracle: the fixtures and models of ``chanwh`` written as
plain SQL CTEs over the driver's pre-registered tables.

``with_ctes(final, *names)`` prefixes a final SELECT with the named CTEs and everything
they depend on, in dependency order.
"""

from __future__ import annotations

# Fixed values, written here on their own: the oracle takes nothing from the code that it checks.
STOP_WORDS = """the and or but in on at to for of with from is are was were a an""".split()
CHANNEL_TYPE_RULES = [('Pharmaceutical', ['pharma', 'pharmaceutical']), ('Cosmetics', ['cosmetic', 'beauty']), ('Medical', ['medical', 'chemed'])]
PERSON_CLASSES = """person people man woman child boy girl""".split()
PRODUCT_CLASSES = ['bottle', 'container', 'cup', 'bowl', 'vase', 'jar', 'potted plant', 'plant', 'book', 'cell phone', 'laptop',
 'handbag', 'backpack', 'suitcase', 'bag']
MEDICAL_CLASSES = ['pills', 'medicine', 'tablet', 'capsule']
IMAGE_CATEGORIES = ['promotional', 'product_display', 'lifestyle', 'other']
CATEGORY_WIDTH = 50
SURROGATE_NULL = '_dbt_utils_surrogate_key_null_'
IMAGE_PATH_RE = r"images/([^/]+)/([0-9]+)\.(jpg|jpeg|png)$"
DEFAULT_MAX_IMAGES = 1500
CONFIG_CHANNELS = [("lobelia4cosmetics", "lobelia", 1), ("CheMed123", "chemed", 2), ("tikvahpharma", "tikvah", 3)]
EXPECTED_CHANNELS = [
    ("CheMed123", ["CheMed", "CheMed123"]),
    ("lobelia4cosmetics", ["Lobelia pharmacy and cosmetics", "lobelia4cosmetics", "Lobelia"]),
    ("tikvahpharma", ["tikvahpharma", "Tikvah", "Tikvah Pharma"]),
]


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def qlist(xs) -> str:
    return "(" + ", ".join(q(x) for x in xs) + ")"


def ratio_int(num: str, den: str, factor: int) -> str:
    """round(num*factor/den) half away from zero, exact, NULL when den = 0."""
    return (f"(sign({num}) * ((2 * abs(cast({num} as hugeint)) * {factor} + cast({den} as hugeint))"
            f" // nullif(2 * cast({den} as hugeint), 0)))")


def pct(num: str, den: str, digits: int = 2) -> str:
    scale = 10 ** digits
    return f"(cast({ratio_int(num, den, 100 * scale)} as double) / {scale})"


def avg_dec2(total: str, count: str) -> str:
    return f"cast(cast({ratio_int(total, count, 100)} as decimal(18,0)) * 0.01 as decimal(10,2))"


def mean(total: str, count: str) -> str:
    return f"(cast({total} as double) / cast({count} as double))"


def surrogate_key(c: str) -> str:
    return f"md5(coalesce(cast({c} as varchar), {q(SURROGATE_NULL)}))"


def channel_type(c: str) -> str:
    parts = []
    for kind, needles in CHANNEL_TYPE_RULES:
        cond = " or ".join(f"contains(lower({c}), {q(n)})" for n in needles)
        parts.append(f"when {cond} then {q(kind)}")
    return "case " + " ".join(parts) + " else 'Other' end"


def fixture_channel(mid: str) -> str:
    return (f"case (({mid} // 5) % 20) % 5 when 0 then 'CheMed' when 1 then 'Lobelia pharmacy and cosmetics' "
            f"when 2 then 'Tikvah | Pharma' when 3 then ' Beauty Hub ' else 'src' || cast(({mid} // 5) % 20 as varchar) end")


def classify(classes_expr: str) -> str:
    person = "[" + ", ".join(q(x) for x in PERSON_CLASSES) + "]"
    product = "[" + ", ".join(q(x) for x in PRODUCT_CLASSES + MEDICAL_CLASSES) + "]"
    hp = f"coalesce(list_has_any({classes_expr}, {person}), false)"
    ho = f"coalesce(list_has_any({classes_expr}, {product}), false)"
    return (f"case when {hp} and {ho} then 'promotional' when {ho} then 'product_display' "
            f"when {hp} then 'lifestyle' else 'other' end")


RAW_REST = ("message_text, has_media, image_path, views, forwards, is_reply, reply_to_msg_id, "
            "scraped_at, loaded_at")

CTES: dict[str, tuple[list[str], str]] = {}


def cte(name: str, deps: list[str], body: str) -> None:
    CTES[name] = (deps, body)


cte("raw_base", [], f"""
select mid as message_id, {fixture_channel('mid')} as channel_name, ts as message_date,
  coalesce(text, case when event_type <> 'error' then event_type || ' by ' || cast(user_id as varchar)
                      when user_id % 2 = 0 then '   ' end) as message_text,
  event_type <> 'error' as has_media,
  case when mid % 2 = 0 then 'data/raw/images/src' || cast((mid // 5) % 20 as varchar) || '/' || cast(mid as varchar) || '.jpg'
       when mid % 3 = 0 then '' end as image_path,
  cast(floor(value) as int) as views,
  case when event_type = 'click' then cast(user_id as int) end as forwards,
  case when mid % 7 = 0 then null else mid % 5 = 0 end as is_reply,
  case when mid % 5 = 0 then mid - 1 end as reply_to_msg_id,
  ts as scraped_at, ts as loaded_at
from (select coalesce(e.event_id, d.doc_id * 5) as mid, e.*, d.text
      from events e full join documents d on e.event_id = d.doc_id * 5) j""")

cte("raw_messages", ["raw_base"], "select * from raw_base")

cte("raw_messages_dup", ["raw_base"], f"""
select message_id, channel_name, message_date, {RAW_REST} from raw_base
union all select message_id, channel_name, message_date + interval 1 day, {RAW_REST} from raw_base where not has_media
union all select message_id, 'CheMed', message_date, {RAW_REST} from raw_base
  where forwards is not null and channel_name <> 'CheMed'""")

cte("stg_messages", ["raw_messages"], """
select cast(message_id as bigint) as message_id, left(trim(channel_name), 255) as channel_name,
  cast(message_date as timestamp) as message_date, cast(message_date as date) as message_date_only,
  coalesce(message_text, '') as message_text, cast(length(coalesce(message_text, '')) as integer) as message_length,
  coalesce(has_media, false) as has_media, left(coalesce(image_path, ''), 500) as image_path,
  (image_path is not null and image_path <> '') as has_image,
  cast(coalesce(views, 0) as integer) as view_count, cast(coalesce(forwards, 0) as integer) as forward_count,
  coalesce(is_reply, false) as is_reply, cast(reply_to_msg_id as bigint) as reply_to_msg_id,
  cast(scraped_at as timestamp) as scraped_at, cast(loaded_at as timestamp) as loaded_at
from raw_messages
where message_id is not null and channel_name is not null and message_date is not null
  and message_text is not null and length(trim(message_text)) > 0""")

cte("dim_channels", ["stg_messages"], f"""
select {surrogate_key('channel_name')} as channel_key, channel_name, {channel_type('channel_name')} as channel_type,
  first_post_date, last_post_date, total_posts, {avg_dec2('sv', 'total_posts')} as avg_views, total_images,
  {pct('total_images', 'total_posts')} as image_percentage
from (select channel_name, min(message_date_only) as first_post_date, max(message_date_only) as last_post_date,
        count(*) as total_posts, sum(view_count) as sv,
        cast(sum(case when has_image then 1 else 0 end) as bigint) as total_images
      from stg_messages group by channel_name) s""")

cte("dim_dates", ["stg_messages"], """
select cast(strftime(full_date, '%Y%m%d') as integer) as date_key, full_date,
  cast(dayofweek(full_date) as integer) as day_of_week, rpad(dayname(full_date), 9, ' ') as day_name,
  cast(weekofyear(full_date) as integer) as week_of_year, cast(month(full_date) as integer) as month,
  rpad(monthname(full_date), 9, ' ') as month_name, cast(quarter(full_date) as integer) as quarter,
  cast(year(full_date) as integer) as year, dayofweek(full_date) in (0, 6) as is_weekend,
  cast(dayofmonth(full_date) as integer) as day_of_month, cast(dayofyear(full_date) as integer) as day_of_year,
  strftime(full_date, '%Y-%m') as year_month
from (select cast(unnest(generate_series(cast(min(message_date_only) as timestamp),
        cast(max(message_date_only) as timestamp), interval 1 day)) as date) as full_date from stg_messages) s""")

cte("fct_messages", ["stg_messages", "dim_channels", "dim_dates"], """
select sm.message_id, dc.channel_key, dd.date_key, sm.message_text, sm.message_length, sm.view_count,
  sm.forward_count, sm.has_image, sm.image_path, sm.is_reply, sm.reply_to_msg_id, sm.message_date,
  sm.scraped_at, sm.loaded_at
from stg_messages sm join dim_channels dc on sm.channel_name = dc.channel_name
  join dim_dates dd on sm.message_date_only = dd.full_date""")

cte("boxes", [], """
select l_orderkey as message_id, l_linenumber as box_id,
  case l_partkey % 8 when 0 then 'person' when 1 then 'bottle' when 2 then 'cup' when 3 then 'dog'
    when 4 then 'book' when 5 then 'car' when 6 then 'potted plant' else 'chair' end as class_name,
  l_discount * 9.5 as confidence, l_quantity as bbox_x1, l_quantity as bbox_y1,
  l_quantity + 10 as bbox_x2, l_quantity + 20 as bbox_y2
from lineitem""")

cte("channel_boxes", ["boxes"], f"select *, {fixture_channel('message_id')} as channel_name from boxes")

cte("raw_image_detections", ["boxes"], f"""
with r as (select message_id, string_agg(class_name, ', ' order by class_name) as detected_classes,
    cast(count(*) as int) as total_detections, max(confidence) as mc,
    max(case when class_name = 'person' then 1 else 0 end) as hp,
    max(case when class_name in ('bottle','cup','book','potted plant') then 1 else 0 end) as ho
  from boxes group by message_id)
select r.message_id, {fixture_channel('r.message_id')} as channel_name,
  case when r.message_id % 4 = 0 then null else 'img' end as image_path, r.detected_classes,
  case when r.message_id % 29 = 0 then null else r.total_detections end as total_detections,
  case when r.message_id % 31 = 0 then null else cast(r.mc as decimal(5,4)) end as max_confidence,
  case when r.message_id % 11 = 0 then ' Promotional ' when r.message_id % 13 = 0 then 'BANNER'
    when r.message_id % 17 = 0 then null when hp = 1 and ho = 1 then 'promotional'
    when ho = 1 then 'product_display' when hp = 1 then 'lifestyle' else 'other' end as image_category,
  timestamp '2024-01-01' + to_days(cast(r.message_id % 30 as int)) as processed_at,
  timestamp '2024-01-01' + to_days(cast(r.message_id % 30 as int)) as loaded_at
from r""")

cte("stg_detections", ["raw_image_detections"], f"""
select cast(message_id as bigint) as message_id, left(trim(channel_name), 255) as channel_name,
  left(coalesce(image_path, ''), 500) as image_path, coalesce(detected_classes, '') as detected_classes,
  cast(coalesce(total_detections, 0) as integer) as total_detections,
  coalesce(cast(max_confidence as decimal(5,4)), cast(0 as decimal(5,4))) as max_confidence,
  case when lower(trim(image_category)) in {qlist(IMAGE_CATEGORIES)}
       then left(lower(trim(image_category)), {CATEGORY_WIDTH}) else 'other' end as image_category,
  cast(processed_at as timestamp) as processed_at, cast(loaded_at as timestamp) as loaded_at
from raw_image_detections
where message_id is not null and channel_name is not null and length(trim(channel_name)) > 0""")

cte("fct_image_detections", ["stg_detections", "stg_messages", "dim_channels", "dim_dates"], """
select sd.message_id, dc.channel_key, dd.date_key, sd.image_path, sd.detected_classes, sd.total_detections,
  sd.max_confidence, sd.image_category, sm.view_count, sm.forward_count, sm.message_date, sd.processed_at
from stg_detections sd join stg_messages sm on sd.message_id = sm.message_id and sd.channel_name = sm.channel_name
  join dim_channels dc on sd.channel_name = dc.channel_name
  join dim_dates dd on sm.message_date_only = dd.full_date""")


def with_ctes(final: str, *names: str, raw: str = "raw_messages") -> str:
    """``final`` prefixed by the named CTEs and their dependencies, in dependency order.

    ``raw='raw_messages_dup'`` builds the models over the duplicate-bearing raw table.
    """
    ctes = dict(CTES)
    if raw != "raw_messages":
        ctes["raw_messages"] = ([raw], f"select * from {raw}")
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for dep in ctes[n][0]:
            visit(dep)
        order.append(n)

    for n in names:
        visit(n)
    body = ",\n".join(f"{n} as ({ctes[n][1]}\n)" for n in order)
    return f"with {body}\n{final}"


STOP_SQL = qlist(STOP_WORDS)


def term_filter(min_length: int) -> str:
    return (f"length(term) >= {min_length} and not regexp_full_match(term, '[0-9]+') "
            f"and term not in {STOP_SQL}")


def terms_cte(min_length: int) -> str:
    return (f"(select term from (select unnest(string_split(lower(trim(message_text)), ' ')) as term "
            f"from fct_messages where message_text is not null and length(trim(message_text)) > 0) t "
            f"where {term_filter(min_length)})")


# ---------------------------------------------------------------------------
# Quality checks in SQL: the fixed list, one line per kind and table
# ---------------------------------------------------------------------------
CHECK_TABLE_CTE = {"stg_channel_messages": "stg_messages", "stg_image_detections": "stg_detections"}
CHECKS = """
not_null stg_channel_messages message_id channel_name message_date message_text message_length view_count forward_count
not_null stg_image_detections message_id channel_name image_category total_detections max_confidence
accepted_values stg_image_detections image_category promotional,product_display,lifestyle,other
unique dim_channels channel_key channel_name
not_null dim_channels channel_key channel_name channel_type first_post_date last_post_date total_posts avg_views
accepted_values dim_channels channel_type Pharmaceutical,Cosmetics,Medical,Other
accepted_range dim_channels total_posts 0 -
accepted_range dim_channels avg_views 0 -
unique dim_dates date_key full_date
not_null dim_dates date_key full_date day_of_week year month is_weekend
not_null fct_messages message_id channel_key date_key message_text message_length view_count forward_count has_image
relationships fct_messages channel_key dim_channels
relationships fct_messages date_key dim_dates
unique_combination fct_messages message_id channel_key
not_null fct_image_detections message_id channel_key date_key image_category total_detections max_confidence view_count
relationships fct_image_detections channel_key dim_channels
relationships fct_image_detections date_key dim_dates
accepted_values fct_image_detections image_category promotional,product_display,lifestyle,other
accepted_range fct_image_detections total_detections 0 -
accepted_range fct_image_detections max_confidence 0 1
unique_combination fct_image_detections message_id channel_key
assert_no_future_messages stg_channel_messages message_date
assert_positive_views stg_channel_messages view_count
assert_valid_date_range stg_channel_messages message_date_only
"""


def _tbl(name: str) -> str:
    return CHECK_TABLE_CTE.get(name, name)


def quality_sql(as_of: str) -> str:
    """One row per check: id, table, columns, failures, passed."""
    rows = []

    def add(check_id: str, table: str, columns: list[str], failures: str) -> None:
        rows.append(f"select {q(check_id)} as check_id, {q(table)} as table_name, {q(','.join(columns))} as column_name, "
                    f"cast({failures} as bigint) as failures, {failures} = 0 as passed")

    for kind, table, *rest in (line.split() for line in CHECKS.strip().splitlines()):
        t, col = _tbl(table), rest[0]
        if kind == "not_null":
            for c in rest:
                add(f"{kind}__{table}__{c}", table, [c], f"(select count(*) from {t} where {c} is null)")
        elif kind == "unique":
            for c in rest:
                add(f"{kind}__{table}__{c}", table, [c],
                    f"(select count(*) from (select {c} from {t} where {c} is not null group by {c} having count(*) > 1) u)")
        elif kind == "accepted_range":
            conds = [f"{col} {op} {v}" for op, v in ((">=", rest[1]), ("<=", rest[2])) if v != "-"]
            add(f"{kind}__{table}__{col}", table, [col], f"(select count(*) from {t} where not ({' and '.join(conds)}))")
        elif kind == "accepted_values":
            add(f"{kind}__{table}__{col}", table, [col], f"(select count(distinct {col}) from {t} where {col} not in {qlist(rest[1].split(','))})")
        elif kind == "unique_combination":
            cols = ", ".join(rest)
            add(f"{kind}__{table}__{'__'.join(rest)}", table, rest,
                f"(select count(*) from (select {cols} from {t} group by {cols} having count(*) > 1) u)")
        elif kind == "relationships":
            add(f"{kind}__{table}__{col}", table, [col], f"(select count(*) from {t} ch where ch.{col} is not null and not exists "
                f"(select 1 from {_tbl(rest[1])} p where p.{col} = ch.{col}))")
        else:
            failing = {
                "assert_no_future_messages": f"message_date > timestamp '{as_of}' or message_date_only > cast(timestamp '{as_of}' as date)",
                "assert_positive_views": "view_count < 0",
                "assert_valid_date_range": "message_date_only < date '2020-01-01' or message_date_only > date '2030-12-31'",
            }[kind]
            add(kind, table, [col], f"(select count(*) from {t} where {failing})")
    return "\nunion all ".join(rows)


def values_sql(rows, cols: str) -> str:
    def lit(v):
        if v is None:
            return "null"
        if isinstance(v, str):
            return q(v)
        return str(v)
    body = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return f"(select * from (values {body}) t({cols}))"
