"""Channel rules: name resolution (J12), expected-channel presence (J10, U3), lake-vs-table
reconciliation (J11), username validity (P13) and per-channel quotas (W1).

The configuration and expected-channel tables are small fixed lists; data-side channel
names are reduced to their distinct values (a partial aggregate) before any theta join.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chanwh.functions import exprs as X

DEFAULT_MAX_IMAGES = 1500


def distinct_names(df: DataFrame, col: str = "channel_name") -> DataFrame:
    return df.where(F.col(col).isNotNull()).select(F.col(col).alias("channel_name")).distinct()


def _grams(text: Column) -> Column:
    """The strings of up to three characters in a short text, and the empty one: what holds a text holds its first
    three characters (or all, if fewer), which makes "contains" an equality of keys."""
    at = F.sequence(F.lit(1), F.greatest(F.length(text), F.lit(1)))
    of = lambda n: F.transform(at, lambda i: F.substr(text, i, F.lit(n)))
    return F.array_distinct(F.concat(F.array(F.lit("")), of(1), of(2), of(3)))


def _keyed(df: DataFrame, into: str, **keys: Column) -> DataFrame:
    """``df`` with a row for each key of each kind, as a struct; nulls give none."""
    none = F.array().cast("array<struct<kind:string,key:string>>")
    of = lambda kind, c: F.coalesce(F.transform(F.filter(c, lambda x: x.isNotNull()), lambda x: F.struct(F.lit(kind).alias("kind"), x.alias("key"))), none)
    return df.withColumn(into, F.explode_outer(F.concat(*(of(kind, c) for kind, c in keys.items()))))


def resolve_channels(names: DataFrame, config: DataFrame) -> DataFrame:
    """Display name → configured channel and caps.

    Tiers, first match wins: exact name; case-insensitive name; normalised name containing
    a configured pattern (in pattern order); otherwise the name itself with the default
    image cap and no message cap.

    names(channel_name) distinct; config(channel, pattern, pattern_order, max_images, max_messages)
    → (channel_name, config_channel, max_images, max_messages, matched)

    Candidates meet by equal keys, the lower-cased name or the beginning of a pattern; the tiers are then
    checked as they are written.
    """
    n = F.col("channel_name")
    c = F.col("channel")
    rank = (F.when(n == c, F.lit(1))
            .when(F.lower(n) == F.lower(c), F.lit(2))
            .when(X.normalized_name(n).contains(F.col("pattern")), F.lit(10) + F.col("pattern_order")))
    own = _keyed(names, "_k", name=F.array(F.lower(n)), part=_grams(X.normalized_name(n)))
    theirs = _keyed(config, "_ck", name=F.array(F.lower(c)), part=F.array(F.left(F.col("pattern"), F.lit(3))))
    # left outer: every name keeps a row; min_by skips the NULL rank of a name without a match,
    # so no join back to the names is needed
    # the pattern order and the name settle equal ranks
    order = F.when(rank.isNotNull(), F.struct(rank.alias("r"), "pattern_order", "channel"))
    pairs = own.join(theirs, F.col("_k") == F.col("_ck"), "left").select(
        "channel_name", order.alias("rank"),
        F.struct(F.col("channel").alias("config_channel"), "max_images", "max_messages").alias("cfg"))
    out = pairs.groupBy("channel_name").agg(F.min_by("cfg", "rank").alias("cfg"))
    return out.select(
        "channel_name",
        F.coalesce(F.col("cfg.config_channel"), n).alias("config_channel"),
        F.coalesce(F.col("cfg.max_images"), F.lit(DEFAULT_MAX_IMAGES)).alias("max_images"),
        F.col("cfg.max_messages").alias("max_messages"),
        F.col("cfg").isNotNull().alias("matched"),
    )


def _presence(names: DataFrame, expected: DataFrame, label: str) -> DataFrame:
    """Per expected channel: is any variant a case-insensitive substring of a name, or vice versa."""
    ln, lv = F.lower(F.col("channel_name")), F.lower(F.col("variant"))
    first = lambda c: F.array(F.left(c, F.lit(3)))
    own = _keyed(names, "_k", holds=_grams(ln), held=first(ln))
    theirs = _keyed(expected, "_ck", holds=first(lv), held=_grams(lv))
    hits = own.join(theirs, F.col("_k") == F.col("_ck")).where(ln.contains(lv) | lv.contains(ln))
    return hits.groupBy("expected_channel").agg(F.count_distinct("channel_name").alias(label))


def expected_presence(lake_names: DataFrame, table_names: DataFrame, expected: DataFrame) -> DataFrame:
    """For each expected channel, found in the lake? found in the table?

    expected(expected_channel, variant) → (expected_channel, found_in_lake, found_in_table)
    """
    chans = expected.select("expected_channel").distinct()
    a = _presence(lake_names, expected, "n_lake")
    b = _presence(table_names, expected, "n_table")
    # a and b hold at most one row per expected channel (a configuration list): broadcast
    j = chans.join(F.broadcast(a), "expected_channel", "left").join(F.broadcast(b), "expected_channel", "left")
    return j.select(
        "expected_channel",
        F.coalesce(F.col("n_lake") > 0, F.lit(False)).alias("found_in_lake"),
        F.coalesce(F.col("n_table") > 0, F.lit(False)).alias("found_in_table"),
    )


def reconcile(lake: DataFrame, table: DataFrame) -> DataFrame:
    """Message counts per channel in the lake and in the table, full outer joined.

    status: 'ok' (both), 'missing_in_table', 'missing_in_lake'.
    """
    a = lake.groupBy("channel_name").agg(F.count(F.lit(1)).alias("lake_count"))
    b = table.groupBy("channel_name").agg(F.count(F.lit(1)).alias("table_count"))
    j = a.join(b, "channel_name", "full_outer")
    status = (F.when(F.col("lake_count").isNull(), "missing_in_lake")
              .when(F.col("table_count").isNull(), "missing_in_table").otherwise("ok"))
    return j.select("channel_name", F.coalesce("lake_count", F.lit(0)).alias("lake_count"),
                    F.coalesce("table_count", F.lit(0)).alias("table_count"), status.alias("status"))


def reconcile_summary(rec: DataFrame) -> DataFrame:
    """J11 totals from ``reconcile`` rows: channels and messages on each side."""
    return rec.agg(
        F.count(F.when(F.col("lake_count") > 0, 1)).alias("lake_channels"),
        F.coalesce(F.sum("lake_count"), F.lit(0)).alias("lake_messages"),
        F.count(F.when(F.col("table_count") > 0, 1)).alias("table_channels"),
        F.coalesce(F.sum("table_count"), F.lit(0)).alias("table_messages"),
    )


def valid_usernames(names: DataFrame) -> DataFrame:
    """P13 over a channel-name table: (channel_name, valid)."""
    return names.select("channel_name", X.valid_username("channel_name").alias("valid"))


# ---------------------------------------------------------------------------
# W1 quota
# ---------------------------------------------------------------------------
#: Message ids that fall into one bin below a second; undated rows have no other bins.
ID_BINS = 20


def _reached(bins: DataFrame, group: list[str], newest: list[Column]) -> DataFrame:
    """The bin of each group in which the summed weight reaches ``_need``, newest bins first; ``_need`` becomes
    what is left to reach inside of it. A group that never reaches it has no row."""
    w = Window.partitionBy(*group).orderBy(*newest)
    upto = bins.withColumn("_upto", F.sum("_w").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    upto = upto.where((F.col("_upto") >= F.col("_need")) & (F.col("_upto") - F.col("_w") < F.col("_need")))
    return upto.withColumn("_need", F.col("_need") - (F.col("_upto") - F.col("_w"))).drop("_upto", "_w")


def cutoffs(rows: DataFrame, held: DataFrame | None) -> DataFrame:
    """Per configured channel, the row with which its message cap is used up and the photo with which its
    image allowance is: (config_channel, kind ``m`` or ``p``, key). No row where a limit is not reached.

    rows(config_channel, channel_name, message_id, message_date, _cap, _images, is_new). Weights are counted per
    day first, then per second and id range of the one day that each limit falls into, then per
    message of that one bin: a window orders bins, never a channel's rows.
    """
    day = F.to_date("message_date")
    days = rows.groupBy("config_channel", day.alias("_day")).agg(F.count(F.lit(1)).alias("m"), F.count_if("is_new").alias("p"), F.max("_cap").alias("_cap"), F.max("_images").alias("_images"))
    if held is not None:
        days = days.join(held, days["config_channel"].eqNullSafe(held["_held_by"]), "left").withColumn("_images", F.col("_images") - F.coalesce("_held", F.lit(0)))
    kinds = F.explode(F.array(F.struct(F.lit("m").alias("kind"), F.col("m").alias("_w"), F.col("_cap").cast("long").alias("_need")),
                              F.struct(F.lit("p").alias("kind"), F.col("p").alias("_w"), F.col("_images").cast("long").alias("_need")))).alias("k")
    days = days.select("config_channel", "_day", kinds).select("config_channel", "_day", "k.*").where("_need > 0")
    first = _reached(days, ["config_channel", "kind"], [F.desc_nulls_last("_day")])

    weight = F.when((F.col("kind") == "m") | F.col("is_new"), 1)
    bins = [F.col("message_date").alias("_second"), F.shiftright("message_id", ID_BINS).alias("_ids")]

    def inside(bound: DataFrame, keys: list[Column]) -> DataFrame:
        """Rows of the bins that limits fall into; a bound has at most two rows for each channel."""
        names = [c for c in bound.columns if c not in ("kind", "_need")]
        b = bound.select(*[F.col(c).alias(f"_b{c}") for c in names], "kind", "_need")
        same = reduce(lambda x, y: x & y, (c.eqNullSafe(F.col(f"_b{n}")) for n, c in zip(names, keys)))
        return rows.join(b, same).withColumn("_w", weight).where("_w = 1")

    own = [F.col("config_channel"), day]
    second = inside(first, own).groupBy("config_channel", "kind", "_need", *bins).agg(F.sum("_w").alias("_w"))
    second = _reached(second, ["config_channel", "kind"], [F.desc_nulls_last("_second"), F.desc_nulls_last("_ids")])
    keys = [F.col("config_channel"), F.col("message_date"), F.shiftright("message_id", ID_BINS)]
    third = inside(second, keys).groupBy("config_channel", "kind", "_need", "message_date", "message_id", "channel_name").agg(F.sum("_w").alias("_w"))
    third = _reached(third, ["config_channel", "kind"], [F.desc_nulls_last("message_date"), F.desc_nulls_last("message_id"), F.asc_nulls_first("channel_name")])
    return third.select("config_channel", "kind", F.struct("message_date", "message_id", "channel_name").alias("key"))


def _at_or_before(key: str) -> Column:
    """Whether a row comes up to the row ``key``, newest first: later dates, larger ids, names in order; missing
    dates and ids last, a missing name first. Every row does if there is no such key."""
    d, i, n = F.col("message_date"), F.col("message_id"), F.col("channel_name")
    kd, ki, kn = (F.col(f"{key}.{c}") for c in ("message_date", "message_id", "channel_name"))
    later = lambda a, b: F.coalesce(a > b, a.isNotNull() & b.isNull())
    name = n.isNull() | F.coalesce(n <= kn, F.lit(False))
    return F.col(key).isNull() | later(d, kd) | (d.eqNullSafe(kd) & (later(i, ki) | (i.eqNullSafe(ki) & name)))


def apply_quota(messages: DataFrame, resolved: DataFrame, stored_images: DataFrame | None = None,
                request_limit: int | None = None) -> DataFrame:
    """Keep at most N newest messages per configured channel and flag which photos fit
    the channel's image cap.

    messages(message_id, channel_name, message_date, image_path, ...)
    resolved: ``resolve_channels`` output; stored_images(channel_name, message_id): images on disk.
    N = least(request_limit, max_messages) (no cap → all). The allowance is the image cap less the
    channel's stored images (of all its display names). Photos are taken newest first: a photo that is
    stored passes without using the allowance, a new one uses it, and once it is used up every older photo
    is refused, as is every photo of a channel without an allowance. An over-cap photo keeps its
    message row. Equal dates and ids of several display names are ordered by name; a repeated row counts
    again and shares its verdict. Rows without a channel form one group with the default cap.
    Output: the kept message rows + config_channel, has_photo, image_downloaded.

    One lazy plan: the messages are counted by bins three times, down to one cut-off row for each limit
    (``cutoffs``), then filtered by it; no window orders a channel's rows.
    """
    caps = resolved.select("channel_name", "config_channel", "max_images", "max_messages")
    config = F.coalesce("config_channel", "channel_name").alias("config_channel")
    limit = F.least("max_messages", F.lit(request_limit).cast("int")) if request_limit is not None else F.col("max_messages")
    m = messages.join(caps, "channel_name", "left").select(
        *[F.col(c) for c in messages.columns], config, limit.alias("_cap"),
        F.coalesce("max_images", F.lit(DEFAULT_MAX_IMAGES)).alias("_images"),
        F.coalesce(F.col("image_path") != "", F.lit(False)).alias("has_photo"))
    rows, held = m.withColumn("is_new", F.col("has_photo")), None
    if stored_images is not None:
        stored = stored_images.select("channel_name", "message_id").distinct()
        held = stored.join(caps, "channel_name", "left").select(config).groupBy(F.col("config_channel").alias("_held_by")).agg(F.count(F.lit(1)).alias("_held"))
        s = stored.select(F.col("channel_name").alias("_sc"), F.col("message_id").alias("_si"), F.lit(True).alias("_stored"))
        rows = rows.join(s, rows["channel_name"].eqNullSafe(s["_sc"]) & (rows["message_id"] == s["_si"]), "left").withColumn("is_new", F.col("has_photo") & F.col("_stored").isNull())
        m = m.join(held, F.col("config_channel").eqNullSafe(F.col("_held_by")), "left").withColumn("_images", F.col("_images") - F.coalesce("_held", F.lit(0)))
    found = cutoffs(rows.select("config_channel", "channel_name", "message_id", "message_date", "_cap", "_images", "is_new"), held)
    found = found.groupBy(F.col("config_channel").alias("_of")).agg(F.max(F.when(F.col("kind") == "m", F.col("key"))).alias("_last"), F.max(F.when(F.col("kind") == "p", F.col("key"))).alias("_photo"))
    out = m.join(found, F.col("config_channel").eqNullSafe(F.col("_of")), "left")
    out = out.where(F.col("_cap").isNull() | ((F.col("_cap") > 0) & _at_or_before("_last")))
    flag = F.col("has_photo") & (F.col("_images") > 0) & _at_or_before("_photo")
    return out.select(*messages.columns, "config_channel", "has_photo", flag.alias("image_downloaded"))
