"""The reusable check builders, and the report that runs many checks per scan.

A check is a set of aggregates over a *frame* and a status over their results;
the status asks for a result by metric name.
Checks on the same frame are computed together, so a table is scanned once for
all its row checks, once for its distinct counts, and once more per duplicate or
reference test.

Sums are NULL on an empty table, and a status that compares them falls through
to its bad outcome: an empty table never passes a row check.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from studylake.functions import columns as fx
from studylake.operators import aggregates, joins
from studylake.quality.report import one_row


Result = Callable[[str], Column]  # metric name to its value
Verdict = Callable[[Result], Column]


@dataclass(frozen=True)
class Check:
    """``metrics`` are reported; ``hidden`` aggregates serve the status alone;
    ``derived`` metrics are computed from finished ones. ``frame`` None is the
    table itself. Checks that count ``distinct`` values share a scan of their own,
    because such counts multiply the rows under every aggregate beside them.
    ``listed`` names the columns whose distinct values belong to the check; they
    are rows of ``check_values``, since no text or task may hold a column's values.
    """

    code: str
    category: str
    name: str
    metrics: Mapping[str, Column]
    status: Verdict
    description: str
    frame: DataFrame | None = None
    hidden: Mapping[str, Column] = field(default_factory=dict)
    derived: Mapping[str, Verdict] = field(default_factory=dict)
    distinct: bool = False
    listed: Sequence[str] = ()


def rows() -> Column:
    return F.count(F.lit(1))


def violations(condition: Column) -> Column:
    """Number of rows that meet ``condition``; NULL on an empty table."""
    return F.sum(F.when(condition, 1).otherwise(0))


def nulls(columns: Mapping[str, str]) -> dict[str, Column]:
    return {name: violations(F.col(c).isNull()) for name, c in columns.items()}


def any_of(conditions: Sequence[Column]) -> Column:
    result = conditions[0]
    for condition in conditions[1:]:
        result = result | condition
    return result


def pass_if_none(metric: str, bad: str = "FAIL") -> Verdict:
    return lambda m: F.when(m(metric) == 0, "PASS").otherwise(bad)


def pass_if_any(metric: str, bad: str = "FAIL") -> Verdict:
    return lambda m: F.when(m(metric) > 0, "PASS").otherwise(bad)


def info(_: Result) -> Column:
    return F.lit("INFO")


# --- completeness --------------------------------------------------------------

def row_count(code: str, description: str = "The table holds at least one row.") -> Check:
    return Check(code, "COMPLETENESS", "Record Count", {"actual_count": rows()},
                 pass_if_any("actual_count"), description)


def not_null(
    code: str, name: str, columns: Mapping[str, str], bad: str = "FAIL",
    description: str = "Required columns are filled.",
) -> Check:
    return Check(
        code, "COMPLETENESS", name, {"total_records": rows(), **nulls(columns)},
        pass_if_none("_any", bad), description,
        hidden={"_any": violations(any_of([F.col(c).isNull() for c in columns.values()]))},
    )


def not_blank(
    code: str, name: str, metric: str, column: str, description: str = "Text is not blank."
) -> Check:
    return Check(
        code, "BUSINESS_RULE", name,
        {"total_records": rows(), metric: violations(F.trim(F.col(column)) == "")},
        pass_if_none(metric), description,
    )


def parseable(
    code: str, name: str, metric: str, columns: Sequence[str], kind: str,
    description: str = "Values have the declared type.",
) -> Check:
    bad = any_of([F.col(c).try_cast(kind).isNull() for c in columns])
    return Check(code, "VALIDITY", name, {"total_records": rows(), metric: violations(bad)},
                 pass_if_none(metric), description)


def completeness(code: str, columns: Mapping[str, str]) -> Check:
    return Check(
        code, "SUMMARY", "Attribute Completeness %",
        {f"{name}_completeness": fx.pct(F.count(c), rows()) for name, c in columns.items()},
        info, "Share of filled values per attribute.",
    )


# --- uniqueness ------------------------------------------------------------------

def unique(
    code: str, name: str, table: DataFrame, keys: Sequence[str], bad: str = "FAIL",
    metric: str = "duplicate_combinations", empty: int | None = 0,
    description: str = "One row per key.",
) -> Check:
    """Counts the keys held by several rows and the rows on them."""
    total = F.sum("duplicate_count")
    return Check(
        code, "UNIQUENESS", name,
        {metric: rows(),
         "total_duplicate_records": total if empty is None else F.coalesce(total, F.lit(empty))},
        pass_if_none(metric, bad), description,
        frame=aggregates.duplicate_groups(table, keys),
    )


def unique_by_distinct(
    code: str, name: str, metric: str, keys: Sequence[str],
    description: str = "One row per key.",
) -> Check:
    """Rows minus distinct keys; a row with a NULL key part counts as surplus."""
    return Check(code, "UNIQUENESS", name, {metric: rows() - F.countDistinct(*keys)},
                 pass_if_none(metric), description, distinct=True)


# --- validity ----------------------------------------------------------------------

def outside_domain(column: Column, values: Sequence) -> Column:
    """A value that is given but not listed."""
    return ~column.isin(list(values))


def in_domain(
    code: str, category: str, name: str, domains: Mapping[str, tuple[Column, Sequence]],
    also: Mapping[str, Column] | None = None, counts: Mapping[str, Column] | None = None,
    listed: Sequence[str] = (),
    description: str = "Values belong to their domain.", total: bool = True,
) -> Check:
    """``also`` are further violations, ``counts`` distinct counts."""
    bad = {m: outside_domain(c, values) for m, (c, values) in domains.items()}
    bad.update(also or {})
    return Check(
        code, category, name,
        {**({"total_records": rows()} if total else {}),
         **{m: violations(b) for m, b in bad.items()}, **(counts or {})},
        pass_if_none("_any"), description,
        hidden={"_any": violations(any_of(list(bad.values())))},
        distinct=bool(counts), listed=listed,
    )


def in_range(
    code: str, category: str, name: str, outside: Mapping[str, Column],
    extra: Mapping[str, Column] | None = None, warn_below: float | None = None,
    description: str = "Values lie in their range.",
) -> Check:
    """With ``warn_below``, a share of violations under it is a WARNING."""

    def verdict(m: Result) -> Column:
        status = F.when(m("_any") == 0, "PASS")
        if warn_below is not None:
            status = status.when(m("_any") < m("total_records") * warn_below, "WARNING")
        return status.otherwise("FAIL")

    return Check(
        code, category, name,
        {"total_records": rows(), **{m: violations(c) for m, c in outside.items()},
         **(extra or {})},
        verdict, description,
        hidden={"_any": violations(any_of(list(outside.values())))},
    )


def ordered_pair(
    code: str, category: str, name: str, metric: str, low: Column, high: Column,
    frame: DataFrame | None = None, total: str = "total_records",
    description: str = "The first value does not exceed the second.",
) -> Check:
    return Check(code, category, name, {total: rows(), metric: violations(low > high)},
                 pass_if_none(metric), description, frame=frame)


def standardized(
    code: str, category: str, name: str, forms: Mapping[str, tuple[str, Column]],
    domains: Mapping[str, tuple[Column, Sequence]] | None = None,
    description: str = "Texts have their standard form.",
) -> Check:
    """``forms`` maps a metric to (column, its standard form)."""
    bad = {m: F.col(c) != form for m, (c, form) in forms.items()}
    bad.update({m: outside_domain(c, v) for m, (c, v) in (domains or {}).items()})
    return Check(
        code, category, name,
        {"total_records": rows(), **{m: violations(b) for m, b in bad.items()}},
        pass_if_none("_any"), description,
        hidden={"_any": violations(any_of(list(bad.values())))},
    )


# --- timeliness --------------------------------------------------------------------

def fresh(
    code: str, as_of: Column, column: str = "ingestion_date", good: int = 7, late: int = 30
) -> Check:

    def verdict(m: Result) -> Column:
        age = m("days_since_last_ingestion")
        return F.when(age <= good, "PASS").when(age <= late, "WARNING").otherwise("FAIL")

    return Check(
        code, "TIMELINESS", "Data Freshness",
        {"latest_ingestion_date": F.max(column),
         "days_since_last_ingestion": fx.age_days(F.max(column), as_of)},
        verdict,
        f"The last load is at most {good} days old, at worst {late}.",
    )


# --- consistency ---------------------------------------------------------------------

def foreign_key(
    code: str, category: str, name: str, metric: str, child: DataFrame, parent: DataFrame,
    on: Sequence[str], bad: str = "FAIL", description: str = "Every row has its parent.",
) -> Check:
    """Orphans, counted per key first, so that a hot key costs one joined row."""
    return Check(code, category, name, {metric: F.max("orphans")},
                 pass_if_none(metric, bad), description,
                 frame=joins.orphan_count(child, parent, on))


def layer_retention(
    code: str, name: str, before: tuple[str, DataFrame], after: tuple[str, DataFrame],
    status: Verdict, derived: Mapping[str, Verdict] | None = None,
    description: str = "The next layer keeps what it should.",
) -> Check:
    """Two one-row counts side by side; ``status`` compares them by name."""
    (left, first), (right, second) = before, after
    counts = one_row(first.toDF(left), second.toDF(right))
    return Check(code, "CONSISTENCY", name, {left: F.max(left), right: F.max(right)}, status,
                 description, frame=counts, derived=derived or {})


def group_total(
    df: DataFrame, by: Sequence[str], amount: str, expected: float, digits: int = 6
) -> DataFrame:
    """Groups whose total is not ``expected``, with the rows affected."""
    totals = df.groupBy(*by).agg(F.sum(amount).alias("group_total"), rows().alias("group_rows"))
    return totals.filter(F.round("group_total", digits) != expected)


def cross_row_rule(
    child: DataFrame, parent: DataFrame, on: Sequence[str], broken: Column
) -> DataFrame:
    """Child rows that contradict their parent row; without a parent there is no verdict."""
    return child.join(parent, list(on)).filter(broken)


# --- information ----------------------------------------------------------------------

def distribution(
    code: str, category: str, name: str, metrics: Mapping[str, Column],
    status: Verdict = info, frame: DataFrame | None = None, distinct: bool = False,
    description: str = "Distribution, for information.",
) -> Check:
    return Check(code, category, name, metrics, status, description, frame=frame,
                 distinct=distinct)


def profile(
    code: str, metrics: Mapping[str, Column], name: str = "Table Profile",
    listed: Sequence[str] = (),
) -> Check:
    """An overview, distinct counts included."""
    return Check(code, "SUMMARY", name, metrics, info, "Overview of the table.", distinct=True,
                 listed=listed)


def distinct_list(code: str, name: str, column: str) -> Check:
    """The distinct values of a column, NULL being one, and how many they are."""
    null = F.coalesce(F.max(F.col(column).isNull().cast("int")), F.lit(0))
    return Check(code, "PROFILE", name, {"distinct_values": F.countDistinct(column) + null}, info,
                 f"Distinct values of {column}.", distinct=True, listed=(column,))


def distinct_values(table: DataFrame, *columns: str) -> DataFrame:
    """The distinct values of each column as rows, from one scan."""
    pairs = F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"))
        for c in columns
    ])
    return table.select(F.inline(pairs)).distinct().orderBy("column_name", "value")


def check_values(
    table: DataFrame, checks: Sequence[Check], layer: str, table_name: str
) -> DataFrame:
    """The distinct values that the checks list, as rows from one scan.

    One row per check, column and value, however many there are; NULL is a value.
    """
    listed = [
        F.struct(F.lit(check.code).alias("check_code"), F.lit(check.name).alias("check_name"),
                 F.lit(column).alias("column_name"), F.col(column).cast("string").alias("value"))
        for check in checks for column in check.listed
    ]
    kind = ("array<struct<check_code:string,check_name:string,column_name:string,value:string>>")
    return table.select(F.inline(F.array(*listed).cast(kind))).distinct().select(
        F.lit(layer).alias("layer_name"), F.lit(table_name).alias("table_name"), "*")


# --- running -----------------------------------------------------------------------------

def _compute(frame: DataFrame, checks: Mapping[str, Check]) -> DataFrame:
    """All aggregates of the checks on one frame, prefixed by check; one row."""
    return frame.agg(*[
        column.alias(prefix + name)
        for prefix, check in checks.items()
        for name, column in {**check.metrics, **check.hidden}.items()
    ])


def _reader(check: Check, prefix: str) -> Result:
    def read(name: str) -> Column:
        if name in check.derived:
            return check.derived[name](read)
        return F.col(prefix + name)

    return read


def _line(check: Check, prefix: str) -> Column:
    read = _reader(check, prefix)
    shown = [*check.metrics, *check.derived]
    return F.struct(
        F.lit(check.code).alias("check_code"),
        F.lit(check.category).alias("check_category"),
        F.lit(check.name).alias("check_name"),
        check.status(read).alias("status"),
        F.map_from_arrays(
            F.array(*[F.lit(n) for n in shown]),
            F.array(*[read(n).cast("string") for n in shown]),
        ).alias("metrics"),
        F.lit(check.description).alias("description"),
    )


def run_check(table: DataFrame, check: Check) -> DataFrame:
    """One check as one row with its metrics as columns."""
    frame = table if check.frame is None else check.frame
    read = _reader(check, "")
    return _compute(frame, {"": check}).select(
        F.lit(check.category).alias("check_category"),
        F.lit(check.name).alias("check_name"),
        *[read(n).alias(n) for n in (*check.metrics, *check.derived)],
        check.status(read).alias("status"),
        F.lit(check.description).alias("description"),
    )


def run_checks(
    table: DataFrame, checks: Sequence[Check], layer: str, table_name: str
) -> DataFrame:
    """One row per check: status and a map of its metrics as text."""
    prefixed = {f"c{i}_": check for i, check in enumerate(checks)}
    frames = []
    for distinct in (False, True):
        own = {
            p: c for p, c in prefixed.items() if c.frame is None and c.distinct == distinct
        }
        if own:
            frames.append(_compute(table, own))
    frames += [
        _compute(c.frame, {p: c}) for p, c in prefixed.items() if c.frame is not None
    ]
    return one_row(*frames).select(
        F.lit(layer).alias("layer_name"),
        F.lit(table_name).alias("table_name"),
        F.inline(F.array(*[_line(c, p) for p, c in prefixed.items()])),
    )
