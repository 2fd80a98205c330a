"""Column expressions shared by every layer. All are built-in Spark functions (no UDFs).

Each helper settles one cross-engine hazard once (rounding, calendar parts, regex anchors,
LIKE escapes, lenient number and timestamp parsing).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's behaviour.
# ---------------------------------------------------------------------------
# Stop words removed from top terms, in the reference's order.
STOP_WORDS = ["the", "and", "or", "but", "in", "on", "at", "to", "for", "of", "with",
              "from", "is", "are", "was", "were", "a", "an"]
# Image categories accepted by the staging model.
IMAGE_CATEGORIES = ["promotional", "product_display", "lifestyle", "other"]
# Channel types accepted by the dimension.
CHANNEL_TYPES = ["Pharmaceutical", "Cosmetics", "Medical", "Other"]
# Channel-type rules, first match wins: (type, substrings of the lower-cased name).
CHANNEL_TYPE_RULES = [
    ("Pharmaceutical", ["pharma", "pharmaceutical"]),
    ("Cosmetics", ["cosmetic", "beauty"]),
    ("Medical", ["medical", "chemed"]),
]
# Object classes that drive the image category.
PERSON_CLASSES = ["person", "people", "man", "woman", "child", "boy", "girl"]
PRODUCT_CLASSES = ["bottle", "container", "cup", "bowl", "vase", "jar", "potted plant", "plant",
                   "book", "cell phone", "laptop", "handbag", "backpack", "suitcase", "bag"]
MEDICAL_CLASSES = ["pills", "medicine", "tablet", "capsule"]
# NULL placeholder of the surrogate-key hash.
SURROGATE_NULL = "_dbt_utils_surrogate_key_null_"
# Widths of the character columns that a cast truncates.
CHANNEL_WIDTH, PATH_WIDTH, CATEGORY_WIDTH = 255, 500, 50
# Blank padding of day and month names.
NAME_PAD = 9


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------------------
# Rounding (H4): exact integer half-away-from-zero on integer inputs.
# ---------------------------------------------------------------------------
def round_ratio_int(num: str | Column, den: str | Column, factor: int) -> Column:
    """round(num * factor / den) half away from zero, as a bigint; NULL when den is 0.

    floor((2|n|k + d) / 2d) computed exactly in decimal(38,0): the remainder is taken
    off first, so the decimal division is of an exact multiple and cannot round.
    """
    n = col(num).cast("decimal(38,0)")
    d = col(den).cast("decimal(38,0)")
    a = F.abs(n) * F.lit(2 * factor).cast("decimal(38,0)") + d
    b = F.nullif(d * F.lit(2).cast("decimal(38,0)"), F.lit(0).cast("decimal(38,0)"))
    q = ((a - F.pmod(a, b)) / b).cast("bigint")
    return F.signum(n).cast("bigint") * q


def pct(num: str | Column, den: str | Column, digits: int = 2) -> Column:
    """Percentage num/den*100 rounded half-up to ``digits`` places, as double; NULL when den is 0."""
    scale = 10 ** digits
    return round_ratio_int(num, den, 100 * scale).cast("double") / F.lit(float(scale))


def pct_or_zero(num: str | Column, den: str | Column, digits: int = 2) -> Column:
    return F.coalesce(pct(num, den, digits), F.lit(0.0))


def avg_dec2(total: str | Column, count: str | Column) -> Column:
    """Exact average rounded half-up to 2 places as decimal(10,2) (numeric(10,2) cast)."""
    q = round_ratio_int(total, count, 100)
    return (q.cast("decimal(18,0)") * F.lit(0.01).cast("decimal(3,2)")).cast("decimal(10,2)")


def mean(total: str | Column, count: str | Column) -> Column:
    """Average as double from an exact integer sum (order-independent, H9)."""
    return col(total).cast("double") / col(count).cast("double")


# ---------------------------------------------------------------------------
# Keys and names
# ---------------------------------------------------------------------------
def surrogate_key(c: str | Column) -> Column:
    return F.md5(F.coalesce(col(c).cast("string"), F.lit(SURROGATE_NULL)))


def varchar(c: str | Column, width: int) -> Column:
    """A character cast that truncates (a Spark varchar cast does not)."""
    return F.left(col(c), F.lit(width))


def channel_type(name: str | Column) -> Column:
    low = F.lower(col(name))
    out = None
    for kind, needles in CHANNEL_TYPE_RULES:
        cond = None
        for n in needles:
            c = low.contains(n)
            cond = c if cond is None else (cond | c)
        out = F.when(cond, F.lit(kind)) if out is None else out.when(cond, F.lit(kind))
    return out.otherwise(F.lit("Other"))


def normalize_category(c: str | Column) -> Column:
    v = F.lower(F.trim(col(c)))
    return F.when(v.isin(*IMAGE_CATEGORIES), varchar(v, CATEGORY_WIDTH)).otherwise(F.lit("other"))


def classify_classes(class_set: str | Column) -> Column:
    """Image category from an array of lower-cased class names."""
    s = col(class_set)
    has_person = F.arrays_overlap(s, F.array(*[F.lit(x) for x in PERSON_CLASSES]))
    has_product = F.arrays_overlap(s, F.array(*[F.lit(x) for x in PRODUCT_CLASSES + MEDICAL_CLASSES]))
    has_person = F.coalesce(has_person, F.lit(False))
    has_product = F.coalesce(has_product, F.lit(False))
    return (F.when(has_person & has_product, "promotional")
            .when(has_product, "product_display")
            .when(has_person, "lifestyle")
            .otherwise("other"))


def safe_file_name(c: str | Column) -> Column:
    """Keep letters, digits, space, '-' and '_'; trim; spaces become '_' (S8, F-str10)."""
    kept = F.regexp_replace(col(c), r"[^\p{L}\p{N} _-]", "")
    return F.translate(F.trim(kept), " ", "_")


def normalized_name(c: str | Column) -> Column:
    """Lower-case and drop spaces, '_' and '-' (F-str9)."""
    return F.regexp_replace(F.lower(col(c)), r"[ _-]", "")


def valid_username(c: str | Column) -> Column:
    """Leading '@'s stripped, at least 5 characters, only letters/digits/underscore."""
    u = F.regexp_replace(col(c), r"^@+", "")
    return F.coalesce(u.rlike(r"^[\p{L}\p{N}_]{5,}\z"), F.lit(False))


def is_all_digits(c: str | Column) -> Column:
    """'^[0-9]+$' without Java's match-before-final-newline (H2)."""
    return col(c).rlike(r"^[0-9]+\z")


# ---------------------------------------------------------------------------
# Calendar (H1)
# ---------------------------------------------------------------------------
def dow0(d: str | Column) -> Column:
    """Day of week with 0 = Sunday."""
    return (F.dayofweek(col(d)) - 1).cast("int")


def day_name(d: str | Column) -> Column:
    return F.rpad(F.date_format(col(d), "EEEE"), NAME_PAD, " ")


def month_name(d: str | Column) -> Column:
    return F.rpad(F.date_format(col(d), "MMMM"), NAME_PAD, " ")


def date_key(d: str | Column) -> Column:
    return F.date_format(col(d), "yyyyMMdd").cast("int")


# ---------------------------------------------------------------------------
# Lenient parsing (H6, H7)
# ---------------------------------------------------------------------------
def parse_bigint(c: str | Column) -> Column:
    """String -> bigint; integral decimals accepted ('7.0'), others NULL ('1.5', 'x')."""
    s = F.trim(col(c).cast("string"))
    d = s.try_cast("double")
    whole = F.when((d == F.floor(d)) & (F.abs(d) < F.lit(9.2e18)), d.try_cast("bigint"))
    return F.coalesce(s.try_cast("bigint"), whole)


def parse_int(c: str | Column) -> Column:
    return parse_bigint(c).try_cast("int")


OFFSET_RE = r"(Z|z|[+-][0-9]{2}(:?[0-9]{2})?)$"


def parse_timestamp(c: str | Column) -> Column:
    """ISO text -> timestamp_ntz (H7): text with an offset (or 'Z') becomes the UTC wall
    clock of that instant; text without one is kept as written. Independent of the
    session time zone."""
    s = F.trim(col(c).cast("string"))
    instant = s.try_cast("timestamp")                           # offset honoured
    as_utc = F.convert_timezone(F.current_timezone(), F.lit("UTC"), instant.cast("timestamp_ntz"))
    return F.when(s.rlike(OFFSET_RE), as_utc).otherwise(s.try_cast("timestamp_ntz"))


def iso_text(c: str | Column, utc_suffix: bool = False) -> Column:
    """ISO-8601 text of a timestamp_ntz: seconds, a 6-digit fraction only when non-zero, and
    '+00:00' when ``utc_suffix`` (the form an aware UTC datetime prints)."""
    base = F.date_format(col(c), "yyyy-MM-dd'T'HH:mm:ss")
    frac = F.date_format(col(c), "SSSSSS")
    txt = F.when(frac == "000000", base).otherwise(F.concat(base, F.lit("."), frac))
    return F.concat(txt, F.lit("+00:00")) if utc_suffix else txt


def parse_bool(c: str | Column) -> Column:
    return F.trim(col(c).cast("string")).try_cast("boolean")


# ---------------------------------------------------------------------------
# LIKE patterns (H3)
# ---------------------------------------------------------------------------
def contains_pattern(query: str) -> str:
    """'%q%' with the user's own wildcards live.

    A backslash escapes only '%', '_' or another backslash; before any other character it
    is dropped (the character is then literal), as the reference's database reads it.
    """
    out = []
    i = 0
    while i < len(query):
        ch = query[i]
        if ch == "\\":
            if i + 1 >= len(query):
                raise ValueError("LIKE pattern must not end with escape character")
            nxt = query[i + 1]
            out.append("\\" + nxt if nxt in "%_\\" else nxt)
            i += 2
            continue
        out.append(ch)
        i += 1
    return "%" + "".join(out) + "%"


def repeated_list(classes: str, name: str, n: str) -> Column:
    """', '-joined names of an array of (name, n), each ``n`` times: the text is repeated per entry, so
    no array of all repeats is built (the text itself grows with the repeats)."""
    text = F.array_join(F.transform(classes, lambda c: F.repeat(F.concat(F.lit(", "), c[name]), c[n])), "")
    return F.substr(text, F.lit(3))
