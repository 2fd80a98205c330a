"""Declarative data-quality checks over the warehouse.

``run_checks(tables)`` → DataFrame(check_id, table_name, column_name, failures, passed).
A check passes with 0 failures. Failure counts follow the usual test semantics:
not_null / accepted_range / custom → failing rows; unique / unique_combination → duplicated
values; accepted_values → distinct invalid values; relationships → orphan child rows.

All checks run in one pass: each table is scanned once, and one grouped count serves uniqueness and
relationships of all tables.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chanwh.functions.exprs import CHANNEL_TYPES, IMAGE_CATEGORIES


@dataclass(frozen=True)
class Check:
    kind: str                     # not_null | unique | accepted_values | relationships | accepted_range
    table: str                    # | unique_combination | custom
    columns: tuple[str, ...]
    values: tuple = ()            # accepted_values
    to: tuple[str, str] | None = None    # relationships: (parent table, parent column)
    lo: float | None = None       # accepted_range (inclusive)
    hi: float | None = None
    name: str = ""                # custom check name

    @property
    def check_id(self) -> str:
        return self.name or f"{self.kind}__{self.table}__{'__'.join(self.columns)}"


def _nn(table: str, *cols: str) -> list[Check]:
    return [Check("not_null", table, (c,)) for c in cols]


STG_M, STG_D = "stg_channel_messages", "stg_image_detections"
DC, DD, FM, FID = "dim_channels", "dim_dates", "fct_messages", "fct_image_detections"

# The warehouse's schema tests (57): not_null 40, unique 4, accepted_values 3,
# relationships 4, accepted_range 4, unique_combination 2.
SCHEMA_CHECKS: list[Check] = [
    *_nn(STG_M, "message_id", "channel_name", "message_date", "message_text", "message_length",
         "view_count", "forward_count"),
    *_nn(STG_D, "message_id", "channel_name", "image_category", "total_detections", "max_confidence"),
    Check("accepted_values", STG_D, ("image_category",), tuple(IMAGE_CATEGORIES)),
    Check("unique", DC, ("channel_key",)), Check("unique", DC, ("channel_name",)),
    *_nn(DC, "channel_key", "channel_name", "channel_type", "first_post_date", "last_post_date",
         "total_posts", "avg_views"),
    Check("accepted_values", DC, ("channel_type",), tuple(CHANNEL_TYPES)),
    Check("accepted_range", DC, ("total_posts",), lo=0),
    Check("accepted_range", DC, ("avg_views",), lo=0),
    Check("unique", DD, ("date_key",)), Check("unique", DD, ("full_date",)),
    *_nn(DD, "date_key", "full_date", "day_of_week", "year", "month", "is_weekend"),
    *_nn(FM, "message_id", "channel_key", "date_key", "message_text", "message_length", "view_count",
         "forward_count", "has_image"),
    Check("relationships", FM, ("channel_key",), to=(DC, "channel_key")),
    Check("relationships", FM, ("date_key",), to=(DD, "date_key")),
    Check("unique_combination", FM, ("message_id", "channel_key")),
    *_nn(FID, "message_id", "channel_key", "date_key", "image_category", "total_detections",
         "max_confidence", "view_count"),
    Check("relationships", FID, ("channel_key",), to=(DC, "channel_key")),
    Check("relationships", FID, ("date_key",), to=(DD, "date_key")),
    Check("accepted_values", FID, ("image_category",), tuple(IMAGE_CATEGORIES)),
    Check("accepted_range", FID, ("total_detections",), lo=0),
    Check("accepted_range", FID, ("max_confidence",), lo=0, hi=1),
    Check("unique_combination", FID, ("message_id", "channel_key")),
]

# The three custom assertions (Q7-Q9) on the staged messages.
VALID_DATE_LO, VALID_DATE_HI = "2020-01-01", "2030-12-31"
CUSTOM_CHECKS: list[Check] = [
    Check("custom", STG_M, ("message_date",), name="assert_no_future_messages"),
    Check("custom", STG_M, ("view_count",), name="assert_positive_views"),
    Check("custom", STG_M, ("message_date_only",), name="assert_valid_date_range"),
]
ALL_CHECKS = SCHEMA_CHECKS + CUSTOM_CHECKS


def _lit(v) -> str:
    return "'" + str(v).replace("'", "''") + "'"


def _ident(c: str) -> str:
    return "`" + c.replace("`", "``") + "`"


def _as_of_sql(as_of) -> str:
    return "CAST(current_timestamp() AS TIMESTAMP_NTZ)" if as_of is None else f"CAST({_lit(as_of)} AS TIMESTAMP_NTZ)"


def row_predicate_sql(c: Check, as_of=None) -> str:
    """The failing-row predicate of a row-level check, as a SQL expression (NULL → not failing)."""
    col = _ident(c.columns[0])
    if c.kind == "not_null":
        return f"{col} IS NULL"
    if c.kind == "accepted_range":
        conds = ["true"]
        if c.lo is not None:
            conds.append(f"{col} >= {c.lo}")
        if c.hi is not None:
            conds.append(f"{col} <= {c.hi}")
        return f"NOT ({' AND '.join(conds)})"
    if c.name == "assert_no_future_messages":
        ts = _as_of_sql(as_of)
        return f"(`message_date` > {ts}) OR (`message_date_only` > to_date({ts}))"
    if c.name == "assert_positive_views":
        return "`view_count` < 0"
    if c.name == "assert_valid_date_range":
        d = "`message_date_only`"
        return f"({d} < DATE {_lit(VALID_DATE_LO)}) OR ({d} > DATE {_lit(VALID_DATE_HI)})"
    raise ValueError(c.kind)


def row_predicate(c: Check, as_of=None) -> F.Column:
    """The failing-row predicate of a row-level check."""
    return F.expr(row_predicate_sql(c, as_of))


def failing_rows(tables: dict[str, DataFrame], c: Check, as_of=None) -> DataFrame:
    """The rows (or groups / values) a check reports."""
    df = tables[c.table]
    if c.kind in ("not_null", "accepted_range", "custom"):
        return df.where(row_predicate(c, as_of))
    if c.kind in ("unique", "unique_combination"):
        base = df.where(F.col(c.columns[0]).isNotNull()) if c.kind == "unique" else df
        return base.groupBy(*c.columns).agg(F.count(F.lit(1)).alias("n_records")).where(F.col("n_records") > 1)
    if c.kind == "accepted_values":
        v = F.col(c.columns[0])
        return df.groupBy(v).agg(F.count(F.lit(1)).alias("n_records")).where(~v.isin(*c.values))
    if c.kind == "relationships":
        ptable, pcol = c.to
        parent = tables[ptable].select(F.col(pcol).alias(c.columns[0])).distinct()
        child = df.where(F.col(c.columns[0]).isNotNull())
        return child.join(parent, c.columns[0], "left_anti")
    raise ValueError(c.kind)


def _entries_sql(table: str, checks: list[Check], links: dict[Check, int], parents: set[tuple[str, str]], as_of) -> list[str]:
    """What a row of ``table`` contributes, as SQL structs (slot, key, part), null for nothing: its keys for
    uniqueness and as a parent (part -1), its foreign keys (part: the number of the relationship), invalid
    values, and row checks that it fails."""
    def entry(slot: str, columns: tuple[str, ...], when: str, part: int = -1) -> str:
        key = ", ".join(f"CAST({_ident(c)} AS STRING)" for c in columns)
        return f"CASE WHEN {when} THEN named_struct('slot', {_lit(slot)}, 'key', CAST(array({key}) AS ARRAY<STRING>), 'part', {part}) END"

    out = {}
    for c in checks:
        col = _ident(c.columns[0])
        if c.kind == "relationships":
            out[c.check_id] = entry(_slot(*c.to), c.columns, f"{col} IS NOT NULL", links[c])
        elif c.kind == "unique":
            out[_slot(table, c.columns[0])] = entry(_slot(table, c.columns[0]), c.columns, f"{col} IS NOT NULL")
        elif c.kind == "unique_combination":
            out[c.check_id] = entry(c.check_id, c.columns, "true")
        elif c.kind == "accepted_values":
            out[c.check_id] = entry(c.check_id, c.columns, f"NOT ({col} IN ({', '.join(_lit(v) for v in c.values)}))")
        else:
            out[c.check_id] = entry(c.check_id, (), row_predicate_sql(c, as_of))
    for ptable, pcol in parents:
        if ptable == table:
            out.setdefault(_slot(table, pcol), entry(_slot(table, pcol), (pcol,), f"{_ident(pcol)} IS NOT NULL"))
    return list(out.values())


def _slot(table: str, column: str) -> str:
    return f"key__{table}__{column}"


def run_checks(tables: dict[str, DataFrame], checks: list[Check] | None = None, as_of=None) -> DataFrame:
    """Run ``checks`` over ``tables`` (name → DataFrame) and return one row per check.

    Each table is scanned ONCE: a row emits its keys, its foreign keys and the row checks that it fails (most
    rows: keys only), all tables' entries are counted by (slot, key) in one grouped count, combined in the
    tasks, and one aggregate over these counts gives all failures: keys counted twice are not unique, foreign
    keys counted where no parent row has the key are orphans. Entries and results are built as SQL
    expressions (one call per table), so a long check list costs little on the driver.
    """
    checks = ALL_CHECKS if checks is None else checks
    links = {c: i for i, c in enumerate(c for c in checks if c.kind == "relationships")}
    parents = {c.to for c in links}
    used = dict.fromkeys([c.table for c in checks] + [t for t, _ in sorted(parents)])
    entries = []
    for table in used:
        structs = _entries_sql(table, [c for c in checks if c.table == table], links, parents, as_of)
        entries.append(tables[table].selectExpr(f"inline(filter(array({', '.join(structs)}), e -> e IS NOT NULL))"))
    counts = reduce(DataFrame.unionByName, entries).groupBy("slot", "key").agg(
        F.count_if(F.col("part") == -1).alias("n"), *(F.count_if(F.col("part") == i).alias(f"c{i}") for i in links.values()))

    def failures(c: Check) -> str:
        if c.kind == "relationships":
            return f"coalesce(sum(CASE WHEN slot = {_lit(_slot(*c.to))} AND n = 0 THEN c{links[c]} END), 0)"
        if c.kind in ("unique", "unique_combination"):
            return f"count_if(slot = {_lit(_slot(c.table, c.columns[0]) if c.kind == 'unique' else c.check_id)} AND n > 1)"
        if c.kind == "accepted_values":
            return f"count_if(slot = {_lit(c.check_id)})"
        return f"coalesce(sum(CASE WHEN slot = {_lit(c.check_id)} THEN n END), 0)"

    one = counts.selectExpr(*(f"{failures(c)} AS _c{i}" for i, c in enumerate(checks)))
    structs = [f"named_struct('check_id', {_lit(c.check_id)}, 'table_name', {_lit(c.table)}, 'column_name', {_lit(','.join(c.columns))}, "
               f"'failures', CAST(_c{i} AS BIGINT))" for i, c in enumerate(checks)]
    return one.selectExpr(f"inline(array({', '.join(structs)}))").selectExpr("*", "failures = 0 AS passed")
