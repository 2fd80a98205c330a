"""Analytical reports over the star schema.

Each report returns flat rows (a lazy DataFrame) plus, where the reference returns a
nested response, a one-row envelope built from the already-bounded rows.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chanwh.functions import exprs as X


class ChannelNotFound(LookupError):
    """The requested channel has no dimension row."""


def check_range(name: str, value: int, lo: int, hi: int) -> None:
    """Argument checks before any plan is built."""
    if not isinstance(value, int) or isinstance(value, bool) or not lo <= value <= hi:
        raise ValueError(f"{name} must be an integer in [{lo}, {hi}], got {value!r}")


def stamped(envelope: DataFrame, generated_at: _dt.datetime | None = None) -> DataFrame:
    """A response with ``generated_at``, the time it is made (default now), as the last column."""
    at = F.current_timestamp().cast("timestamp_ntz") if generated_at is None else F.lit(generated_at).cast("timestamp_ntz")
    return envelope.withColumn("generated_at", at)


def _as_of(as_of) -> F.Column:
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, (_dt.date, _dt.datetime)):
        as_of = as_of.isoformat()[:10]
    return F.lit(str(as_of)).cast("date")


# ---------------------------------------------------------------------------
# N1 top terms
# ---------------------------------------------------------------------------
def term_counts(fct: DataFrame, min_length: int = 4) -> DataFrame:
    """(term, frequency) for every term that passes P8, no HAVING yet.

    The explode multiplies rows by words per message, so the projection is a single
    column and the filter runs before the shuffle; partial aggregation combines map-side.
    """
    check_range("min_length", min_length, 2, 20)
    texts = fct.where(F.col("message_text").isNotNull() & (F.length(F.trim("message_text")) > 0))
    terms = texts.select(F.explode(F.split(F.lower(F.trim("message_text")), " ", -1)).alias("term"))
    t = F.col("term")
    kept = terms.where((F.length(t) >= min_length) & ~X.is_all_digits(t) & ~t.isin(*X.STOP_WORDS))
    return kept.groupBy("term").agg(F.count(F.lit(1)).alias("frequency"))


def top_terms(fct: DataFrame, limit: int = 10, min_length: int = 4) -> DataFrame:
    """N1 rows: (term, frequency, percentage) for terms seen at least twice (A4), percentage
    of all such occurrences (A5), by frequency desc then term (T1)."""
    check_range("limit", limit, 1, 100)
    counts = term_counts(fct, min_length).where(F.col("frequency") >= 2)
    # the denominator is one scalar subquery over the same (reused) aggregate, bound once to
    # a column so the rounding expression does not re-plan it
    total = counts.agg(F.sum("frequency")).scalar()
    scored = counts.select("term", "frequency", total.alias("_total"))
    scored = scored.select("term", "frequency", X.pct("frequency", "_total").alias("percentage"))
    # Limit directly over Sort → TakeOrderedAndProject: per-partition top-k, no global sort
    return scored.orderBy(F.desc("frequency"), F.asc("term")).limit(limit)


def top_terms_total(fct: DataFrame, min_length: int = 4) -> DataFrame:
    """N1 totals: distinct terms without the HAVING filter (A6), plus the A5 denominator."""
    counts = term_counts(fct, min_length)
    return counts.agg(
        F.count(F.lit(1)).alias("total_terms"),
        F.coalesce(F.sum(F.when(F.col("frequency") >= 2, F.col("frequency"))), F.lit(0)).alias("counted_occurrences"),
    )


def top_terms_envelope(fct: DataFrame, limit: int = 10, min_length: int = 4) -> DataFrame:
    """N1 response: (limit, total_terms, products array<struct>) from at most ``limit`` rows. Rows and
    totals come from one grouped count of the terms (its exchange is reused)."""
    check_range("limit", limit, 1, 100)
    counts = term_counts(fct, min_length)
    f = F.col("frequency")
    totals = counts.agg(F.struct(F.count(F.lit(1)).alias("terms"), F.sum(F.when(f >= 2, f)).alias("shown")).alias("t")).scalar()
    scored = counts.where(f >= 2).select("term", "frequency", totals.alias("t")).select(
        "term", "frequency", X.pct("frequency", "t.shown").alias("percentage"))
    rows = scored.orderBy(F.desc("frequency"), F.asc("term")).limit(limit)
    prods = rows.agg(F.sort_array(F.collect_list(F.struct(
        (-f).alias("k"), "term", "frequency", "percentage"))).alias("p"))
    products = F.transform(F.coalesce("p", F.array()), lambda s: F.struct(
        s["term"].alias("term"), s["frequency"].alias("frequency"), s["percentage"].alias("percentage")))
    return prods.select(F.lit(limit).alias("limit"), totals["terms"].alias("total_terms"), products.alias("products"))


# ---------------------------------------------------------------------------
# N2 channel activity
# ---------------------------------------------------------------------------
def require_channel(dc: DataFrame, channel: str) -> None:
    """Raises ChannelNotFound if the channel has no dimension row (one small job)."""
    if dc.where(F.col("channel_name") == channel).isEmpty():
        raise ChannelNotFound(channel)


def _channel_facts(fct: DataFrame, dc: DataFrame, channel: str) -> DataFrame:
    """Facts of one channel (J4). The key is a hash of the name, so the filter also reaches
    the fact scan directly (row-group skipping on a channel-clustered fact)."""
    key = X.surrogate_key(F.lit(channel))
    c = dc.where(F.col("channel_name") == channel).select("channel_key", "channel_name")
    return fct.where(F.col("channel_key") == key).join(c, "channel_key")


def channel_totals(fct: DataFrame, dc: DataFrame, channel: str, check: bool = True) -> DataFrame:
    """N2 header: dimension attributes + lifetime totals (A7); ignores the look-back window. An unknown channel is
    an error at once (P16), or without ``check`` no row."""
    if check:
        require_channel(dc, channel)
    info = dc.where(F.col("channel_name") == channel).select("channel_name", "channel_type", "first_post_date", "last_post_date")
    s = _channel_facts(fct, dc, channel).groupBy("channel_name").agg(
        F.count(F.lit(1)).alias("_n"),
        F.sum("view_count").alias("_tv"),
        F.sum("forward_count").alias("_tf"),
    )
    j = info.join(F.broadcast(s), "channel_name", "left")    # ≤ 1 row each side
    n = F.coalesce(F.col("_n"), F.lit(0))
    return j.select(
        "channel_name", "channel_type",
        n.alias("total_messages"),
        F.coalesce(F.col("_tv"), F.lit(0)).alias("total_views"),
        F.coalesce(X.mean("_tv", "_n"), F.lit(0.0)).alias("avg_views"),
        F.coalesce(F.col("_tf"), F.lit(0)).alias("total_forwards"),
        "first_post_date", "last_post_date",
    )


def channel_daily(fct: DataFrame, dc: DataFrame, dd: DataFrame, channel: str, days: int = 30,
                  as_of=None, check: bool = True) -> DataFrame:
    """N2 rows: per-day activity of one channel from ``as_of - days`` on (P11, A8, J6, T3). An unknown channel is
    an error at once (P16), or without ``check`` no row."""
    check_range("days", days, 1, 365)
    if check:
        require_channel(dc, channel)
    f = _channel_facts(fct, dc, channel)
    d = dd.select("date_key", "full_date").where(F.col("full_date") >= F.date_sub(_as_of(as_of), days))
    g = f.join(d, "date_key").groupBy("full_date").agg(
        F.count(F.lit(1)).alias("message_count"),
        F.sum("view_count").alias("_tv"),
        F.sum("forward_count").alias("_tf"),
    )
    return g.select(
        F.col("full_date").alias("activity_date"),
        "message_count",
        F.coalesce(F.col("_tv"), F.lit(0)).alias("total_views"),
        F.coalesce(X.mean("_tv", "message_count"), F.lit(0.0)).alias("avg_views"),
        F.coalesce(F.col("_tf"), F.lit(0)).alias("total_forwards"),
    ).orderBy(F.desc("activity_date"))


def channel_activity_envelope(fct, dc, dd, channel: str, days: int = 30, as_of=None, check: bool = True) -> DataFrame:
    """N2 response: the header row with ``daily_activity`` (newest first) as an array of structs;
    the array holds one entry per day of the look-back, so it is bounded by the date dimension.

    One pass over the channel's facts: they are summed by day, and the days once more, all of them for the
    totals and those of the look-back into the array. An unknown channel is an error at once (P16), or without
    ``check`` when the response is read."""
    check_range("days", days, 1, 365)
    if check:
        require_channel(dc, channel)
    by_day = fct.where(F.col("channel_key") == X.surrogate_key(F.lit(channel))).groupBy("date_key").agg(
        F.count(F.lit(1)).alias("n"), F.sum("view_count").alias("tv"), F.sum("forward_count").alias("tf"))
    by_day = by_day.join(dd.select("date_key", "full_date"), "date_key", "left")
    entry = F.struct(F.col("full_date").alias("activity_date"), F.col("n").alias("message_count"), F.coalesce("tv", F.lit(0)).alias("total_views"),
                     F.coalesce(X.mean("tv", "n"), F.lit(0.0)).alias("avg_views"), F.coalesce("tf", F.lit(0)).alias("total_forwards"))
    recent = F.when(F.col("full_date") >= F.date_sub(_as_of(as_of), days), entry)
    sums = by_day.agg(F.sum("n").alias("n"), F.sum("tv").alias("tv"), F.sum("tf").alias("tf"), F.sort_array(F.collect_list(recent), asc=False).alias("days"))
    # the header comes from the dimension's one row, as a struct; without it there is nothing to answer
    info = dc.where(F.col("channel_name") == channel).select(F.struct("channel_name", "channel_type", "first_post_date", "last_post_date")).scalar()
    out = sums.withColumn("c", info).withColumn("c", F.coalesce("c", F.raise_error(F.lit(f"ChannelNotFound: {channel}"))))
    return out.select(
        "c.channel_name", "c.channel_type", F.coalesce("n", F.lit(0)).alias("total_messages"), F.coalesce("tv", F.lit(0)).alias("total_views"),
        F.coalesce(X.mean("tv", "n"), F.lit(0.0)).alias("avg_views"), F.coalesce("tf", F.lit(0)).alias("total_forwards"),
        "c.first_post_date", "c.last_post_date", F.col("days").alias("daily_activity"))


# ---------------------------------------------------------------------------
# N3 search
# ---------------------------------------------------------------------------
def _search_matches(fct: DataFrame, dc: DataFrame, query: str, channel: str | None) -> DataFrame:
    if not isinstance(query, str) or not 2 <= len(query) <= 100:
        raise ValueError("query must be 2 to 100 characters")
    pattern = X.contains_pattern(query)
    hit = F.lower(F.col("message_text")).like(pattern.lower())
    f = fct.where(hit)
    c = dc.select("channel_key", "channel_name")
    if channel:                                               # P10
        f = f.where(F.col("channel_key") == X.surrogate_key(F.lit(channel)))
        c = c.where(F.col("channel_name") == channel)
    return f.join(c, "channel_key")


def search_messages(fct: DataFrame, dc: DataFrame, query: str, limit: int = 20,
                    channel: str | None = None) -> DataFrame:
    """N3 rows (P9, P12, P15, J4, T2). Relevance is 1.0 for every match, as in the reference."""
    check_range("limit", limit, 1, 100)
    # the body is cut before the top-k, which then carries at most 500 characters a row
    m = _search_matches(fct, dc, query, channel).withColumn("message_text", F.left(F.col("message_text"), F.lit(500)))
    top = m.orderBy(F.desc("view_count"), F.desc("message_date"), F.asc("message_id"),
                    F.asc("channel_name")).limit(limit)
    return top.select(
        "message_id", "channel_name",
        "message_text",
        "message_date", "view_count", "forward_count", "has_image",
        F.lit(1.0).alias("relevance_score"),
    )


def search_count(fct: DataFrame, dc: DataFrame, query: str, channel: str | None = None) -> DataFrame:
    """Number of matches."""
    return _search_matches(fct, dc, query, channel).agg(F.count(F.lit(1)).alias("total_found"))


def search_envelope(fct: DataFrame, dc: DataFrame, query: str, limit: int = 20, channel: str | None = None) -> DataFrame:
    """N3 response: (query, limit, total_found, results array<struct>), results in their order."""
    rows = search_messages(fct, dc, query, limit, channel)
    key = F.struct((-F.col("view_count")).alias("v"), (-F.unix_micros(F.col("message_date").cast("timestamp"))).alias("d"), "message_id", "channel_name")
    arr = rows.agg(F.sort_array(F.collect_list(F.struct(key.alias("k"), *[F.col(c) for c in rows.columns]))).alias("r"))
    results = F.transform(F.coalesce("r", F.array()), lambda s: F.struct(*[s[c].alias(c) for c in rows.columns]))
    total = search_count(fct, dc, query, channel).scalar()
    return arr.select(F.lit(query).alias("query"), F.lit(limit).alias("limit"), total.alias("total_found"), results.alias("results"))


# ---------------------------------------------------------------------------
# N4 visual content
# ---------------------------------------------------------------------------
def _cat(name: str) -> F.Column:
    return F.sum(F.when(F.col("image_category") == name, 1).otherwise(0)).cast("bigint")


def visual_by_channel(fid: DataFrame, dc: DataFrame) -> DataFrame:
    """N4 rows (A10, J4, T4)."""
    g = fid.join(dc.select("channel_key", "channel_name"), "channel_key").groupBy("channel_name").agg(
        F.count(F.lit(1)).alias("total_images"),
        _cat("promotional").alias("promotional_count"),
        _cat("product_display").alias("product_display_count"),
        _cat("lifestyle").alias("lifestyle_count"),
        _cat("other").alias("other_count"),
        F.sum("total_detections").alias("_det"),
        F.sum("max_confidence").alias("_conf"),
        F.sum("view_count").alias("_views"),
    )
    return g.select(
        "channel_name", "total_images", "promotional_count", "product_display_count",
        "lifestyle_count", "other_count",
        X.mean("_det", "total_images").alias("avg_detections"),
        X.mean("_conf", "total_images").alias("avg_confidence"),
        X.mean("_views", "total_images").alias("avg_views"),
    ).orderBy(F.desc("total_images"), F.asc("channel_name"))


def _visual_sums(per: DataFrame, *more: F.Column) -> DataFrame:
    """A11 over A10's rows; ``more`` aggregates of these, by name."""
    o = per.agg(
        *more,
        F.coalesce(F.sum("total_images"), F.lit(0)).alias("total_images"),
        F.count(F.lit(1)).alias("total_channels"),
        F.sum("promotional_count").alias("_p"),
        F.sum("product_display_count").alias("_d"),
        F.sum("lifestyle_count").alias("_l"),
        F.sum("other_count").alias("_o"),
    )
    kept = [c for c in o.columns if not c.startswith("_") and c not in ("total_images", "total_channels")]
    return o.select(
        "total_images", "total_channels", *kept,
        X.pct_or_zero("_p", "total_images").alias("overall_promotional_pct"),
        X.pct_or_zero("_d", "total_images").alias("overall_product_display_pct"),
        X.pct_or_zero("_l", "total_images").alias("overall_lifestyle_pct"),
        X.pct_or_zero("_o", "total_images").alias("overall_other_pct"),
    )


def visual_overall(fid: DataFrame, dc: DataFrame) -> DataFrame:
    """A11 as a re-aggregation of A10's per-channel counts (one scan of the fact, not two)."""
    return _visual_sums(visual_by_channel(fid, dc))


def visual_envelope(fid: DataFrame, dc: DataFrame) -> DataFrame:
    """N4 response: the totals with one entry per channel in an array, both from one aggregate of the per-channel
    rows. The nested response grows with the channels; ``visual_by_channel`` is the form for very many."""
    per = visual_by_channel(fid, dc)
    entry = F.struct((-F.col("total_images")).alias("k"), *[F.col(c) for c in per.columns])
    out = _visual_sums(per, F.sort_array(F.collect_list(entry)).alias("channels"))
    channels = F.transform("channels", lambda s: F.struct(*[s[c].alias(c) for c in per.columns]))
    return out.select(*[c for c in out.columns if c != "channels"], channels.alias("channels"))
