"""Data-quality tests. Each returns the rows that break its rule; an empty result is a pass.

Tests that would return copies of one row per offending value return the value once with a `failures` count instead:
the copies are counted on the map side and never meet in one task. `failure_count` handles both shapes.
NULL handling is part of each rule and stated where it is not obvious.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.functions.times import as_of_column
from candlewick.operators.columns import columns_except
from candlewick.operators.joins import side_by_side
from candlewick.operators.ordered import with_next, with_previous

FAILURES = "failures"


# --- single-row rules ------------------------------------------------------------------------------------------
# What makes a row break a rule; a rule lists such rows, a suite counts them.


def _is_null(column: str) -> Column:
    return F.col(column).isNull()


def _out_of_range(column: str, low=None, high=None, inclusive: bool = True) -> Column:
    if low is None and high is None:
        raise ValueError("give low, high or both")
    c = F.col(column)
    broken = []
    if low is not None:
        broken.append(c < low if inclusive else c <= low)
    if high is not None:
        broken.append(c > high if inclusive else c >= high)
    return reduce(lambda a, b: a | b, broken)


def _untrue(expression: str, column: str | None = None) -> Column:
    return ~F.expr(f"{column} {expression}" if column else expression)


def _unequal(actual: str, expected: str) -> Column:
    return F.col(actual) != F.col(expected)


def _empty(column: str, trim: bool = True) -> Column:
    return (F.trim(F.col(column)) if trim else F.col(column)) == ""


def _outside(column: str, values: list) -> Column:
    return ~F.col(column).isin(values)


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(_is_null(column))


def accepted_range(df: DataFrame, column: str, low=None, high=None, inclusive: bool = True) -> DataFrame:
    """Rows outside the bounds; a NULL value passes."""
    return df.filter(_out_of_range(column, low, high, inclusive))


def expression_is_true(df: DataFrame, expression: str, column: str | None = None) -> DataFrame:
    """Rows where the expression is false; unknown passes. `column` is put in front of the expression."""
    return df.filter(_untrue(expression, column))


def assert_equal(df: DataFrame, actual: str, expected: str) -> DataFrame:
    """Rows where the two differ; NULL on either side passes."""
    return df.filter(_unequal(actual, expected))


def not_empty_string(df: DataFrame, column: str, trim: bool = True) -> DataFrame:
    text = F.trim(F.col(column)) if trim else F.col(column)
    return df.select(text.alias(column)).filter(F.col(column) == "")


# --- rules over the values of a column --------------------------------------------------------------------------


def _tally(df: DataFrame, *columns: str) -> DataFrame:
    return df.groupBy(*columns).agg(F.count("*").alias(FAILURES))


def accepted_values(df: DataFrame, column: str, values: list) -> DataFrame:
    """Values outside the list, each with its number of rows; NULL passes."""
    return _tally(df.filter(_outside(column, values)), column)


def not_accepted_values(df: DataFrame, column: str, values: list) -> DataFrame:
    """Forbidden values that occur, once each."""
    return df.filter(F.col(column).isin(values)).select(column).distinct()


def unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once; NULLs are not compared."""
    return _row_counts(df.filter(F.col(column).isNotNull()), [column]).filter("n_records > 1")


def unique_combination(df: DataFrame, columns: list[str]) -> DataFrame:
    return _row_counts(df, columns).filter("n_records > 1").select(*columns)


def _row_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.groupBy(*columns).agg(F.count("*").alias("n_records"))


def at_least_one(df: DataFrame, column: str, group_by: list[str] = ()) -> DataFrame:
    """Groups (or the whole table) without a single value."""
    if group_by:
        return df.groupBy(*group_by).agg(F.count(column).alias("value_count")).filter("value_count = 0")
    one = df.filter(F.col(column).isNotNull()).select(column).limit(1)
    return one.agg(F.count(column).alias("value_count")).filter("value_count = 0")


def not_constant(df: DataFrame, column: str, group_by: list[str] = ()) -> DataFrame:
    """Groups with exactly one distinct value. Smallest equals largest: no need to collect the distinct values."""
    bounds = [F.min(column).alias("low"), F.max(column).alias("high")]
    grouped = df.groupBy(*group_by).agg(*bounds)
    return grouped.filter("low = high").select(*group_by, F.lit(1).cast("long").alias("distinct_values"))


def not_null_proportion(
    df: DataFrame, column: str, at_least: float, at_most: float = 1.0, group_by: list[str] = ()
) -> DataFrame:
    filled = F.avg(F.when(F.col(column).isNotNull(), 1.0).otherwise(0.0)).alias("not_null_proportion")
    share = F.col("not_null_proportion")
    return df.groupBy(*group_by).agg(filled).filter((share < at_least) | (share > at_most))


def recency(
    df: DataFrame,
    column: str,
    part: str,
    interval: int,
    as_of=None,
    ignore_time: bool = False,
    group_by: list[str] = (),
) -> DataFrame:
    """Groups whose newest value is older than `as_of` minus the interval; a group of NULLs passes."""
    kind = "date" if ignore_time else "timestamp"
    threshold = F.timestamp_add(part.upper(), F.lit(-interval), as_of_column(as_of)).cast(kind)
    newest = df.groupBy(*group_by).agg(F.max(column).cast(kind).alias("most_recent"))
    return newest.withColumn("threshold", threshold).filter("most_recent < threshold")


# --- rules over neighbouring rows ------------------------------------------------------------------------------


def sequential_values(
    df: DataFrame,
    column: str,
    interval: int = 1,
    part: str | None = None,
    group_by: list[str] = (),
    slices: int | None = None,
) -> DataFrame:
    """Values that do not follow their predecessor by exactly `interval` (`part`s for times).

    Equal values are folded first: every copy after the first follows itself and fails.
    """
    folded = df.groupBy(*group_by, column).agg(F.count("*").alias("copies"))
    linked = with_previous(folded.filter(F.col(column).isNotNull()), list(group_by), [column],
                           {column: "previous"}, slices)
    if part:
        due = F.timestamp_add(part.upper(), F.lit(interval), F.col("previous").cast("timestamp"))
        off = F.col(column).cast("timestamp") != due
    else:
        off = F.col(column) != F.col("previous") + F.lit(interval)
    name = f"previous_{column}"
    repeats = interval != 0
    first = F.struct(F.col("previous"), F.when(off, 1).otherwise(0).cast("long").alias(FAILURES))
    copies = F.struct(
        F.col(column).alias("previous"),
        (F.col("copies") - 1 if repeats else F.lit(0)).cast("long").alias(FAILURES),
    )
    checked = linked.select(*group_by, column, F.explode(F.array(first, copies)).alias("c"))
    return checked.filter(f"c.{FAILURES} > 0").select(
        *group_by, column, F.col("c.previous").alias(name), f"c.{FAILURES}"
    )


def mutually_exclusive_ranges(
    df: DataFrame,
    lower: str,
    upper: str,
    partition_by: str | None = None,
    gaps: str = "allowed",
    zero_length: bool = False,
    slices: int | None = None,
) -> DataFrame:
    """Ranges that are empty or reversed, overlap the next one, or break the gap rule; NULL bounds fail.

    `lower` and `upper` may be expressions. Equal ranges are folded first and carry a `failures` count.
    """
    fits: dict[str, Callable[[Column, Column], Column]] = {
        "not_allowed": lambda a, b: a == b,
        "allowed": lambda a, b: a <= b,
        "required": lambda a, b: a < b,
    }
    if gaps not in fits:
        raise ValueError(f"gaps must be one of {sorted(fits)}")
    keys = ["partition_key"] if partition_by else []
    named = [F.expr(partition_by).alias("partition_key")] if partition_by else []
    ranges = df.select(*named, F.expr(lower).alias("lower_bound"), F.expr(upper).alias("upper_bound"))
    folded = ranges.groupBy(*ranges.columns).agg(F.count("*").alias("copies"))
    linked = with_next(folded, keys, ["lower_bound", "upper_bound"], {"lower_bound": "next_lower_bound"}, slices)
    low, high = F.col("lower_bound"), F.col("upper_bound")
    ordered = F.coalesce(low <= high if zero_length else low < high, F.lit(False))

    def broken(next_low: Column, is_last: Column) -> Column:
        return ~(ordered & F.coalesce(fits[gaps](high, next_low), is_last, F.lit(False)))

    last_copy = F.struct(
        F.col("next_lower_bound"),
        F.when(broken(F.col("next_lower_bound"), ~F.col("has_next")), 1).otherwise(0).cast("long").alias(FAILURES),
    )
    other_copies = F.struct(
        low.alias("next_lower_bound"),
        F.when(broken(low, F.lit(False)), F.col("copies") - 1).otherwise(0).cast("long").alias(FAILURES),
    )
    checked = linked.select(*ranges.columns, F.explode(F.array(last_copy, other_copies)).alias("c"))
    return checked.filter(f"c.{FAILURES} > 0").select(*ranges.columns, "c.*")


# --- rules over two tables -------------------------------------------------------------------------------------


def relationships_where(
    df: DataFrame, column: str, to: DataFrame, to_column: str, from_condition: str = "true", to_condition: str = "true"
) -> DataFrame:
    """Values without a partner in `to`, with their number of rows; NULLs on the left are left out."""
    left = df.filter(from_condition).filter(F.col(column).isNotNull()).select(F.col(column).alias("id"))
    right = to.filter(to_condition).select(F.col(to_column).alias("id"))
    # Counted before the join: a value with many rows enters it once.
    return _tally(left, "id").join(right.distinct(), "id", "left_anti")


def _both_sides(a: DataFrame, b: DataFrame, columns: list[str]) -> DataFrame:
    """Row counts of either side per distinct combination, NULLs equal, in one shuffle."""
    sides = a.select(*columns, F.lit(1).alias("_a"), F.lit(0).alias("_b")).unionByName(
        b.select(*columns, F.lit(0).alias("_a"), F.lit(1).alias("_b"))
    )
    return sides.groupBy(*columns).agg(F.sum("_a").alias("_a"), F.sum("_b").alias("_b"))


def equality(
    df: DataFrame,
    other: DataFrame,
    compare: list[str] | None = None,
    exclude: list[str] | None = None,
    precision: int | None = None,
) -> DataFrame:
    """Distinct rows found on one side only, tagged with the side. Numbers are rounded to `precision` digits."""
    if compare and exclude:
        raise ValueError("give compare or exclude, not both")
    if compare:
        columns = list(compare)
    else:
        columns = columns_except(df, exclude or [])
        if {c.lower() for c in columns} != {c.lower() for c in columns_except(other, exclude or [])}:
            raise ValueError("the tables have different columns; use compare or exclude")

    def prepared(source: DataFrame) -> DataFrame:
        types = {f.name.lower(): f.dataType for f in source.schema}
        rounded = precision is not None

        def value(c: str) -> Column:
            kind = types[c.lower()]
            if rounded and isinstance(kind, (T.FractionalType, T.DecimalType)):
                return F.round(F.col(c).cast("decimal(38,12)"), precision).alias(c)
            return F.col(c)

        return source.select([value(c) for c in columns])

    counted = _both_sides(prepared(df), prepared(other), columns)
    side = F.when(F.col("_b") == 0, "a_minus_b").when(F.col("_a") == 0, "b_minus_a")
    return counted.select(side.alias("which_diff"), *columns).filter(F.col("which_diff").isNotNull())


def cardinality_equality(df: DataFrame, column: str, other: DataFrame, other_column: str) -> DataFrame:
    """(value, num_rows) pairs that exist on one side only."""
    counted = _both_sides(
        df.select(F.col(column).alias("value")), other.select(F.col(other_column).alias("value")), ["value"]
    )
    pair = F.explode(F.array("_a", "_b")).alias("num_rows")
    return counted.filter("_a <> _b").select("value", pair).filter("num_rows > 0")


def _counts_side_by_side(df: DataFrame, other: DataFrame, group_by: list[str]) -> DataFrame:
    """Full join of the two counts per group by plain equality, so NULL groups stay apart."""
    a = df.groupBy(*[F.col(c).alias(f"{c}_a") for c in group_by]).agg(F.count("*").alias("count_a"))
    b = other.groupBy(*[F.col(c).alias(f"{c}_b") for c in group_by]).agg(F.count("*").alias("count_b"))
    if not group_by:
        return side_by_side(a, b)
    return a.join(b, reduce(lambda x, y: x & y, [F.col(f"{c}_a") == F.col(f"{c}_b") for c in group_by]), "full")


def equal_rowcount(
    df: DataFrame, other: DataFrame, group_by: list[str] = (), missing_groups_fail: bool = False
) -> DataFrame:
    """All groups with their row difference as `failures`; a group on one side only counts 0 unless asked otherwise."""
    delta = F.abs(F.col("count_a") - F.col("count_b"))
    absent = F.coalesce("count_a", "count_b") if missing_groups_fail else F.lit(0)
    return _counts_side_by_side(df, other, list(group_by)).withColumn(FAILURES, F.coalesce(delta, absent).cast("long"))


def fewer_rows_than(
    df: DataFrame, other: DataFrame, group_by: list[str] = (), missing_groups_fail: bool = False
) -> DataFrame:
    """All groups with `failures`: the surplus when df has more rows, 1 when both have the same number."""
    a, b = F.col("count_a"), F.col("count_b")
    absent = F.when(b.isNull(), a).otherwise(0) if missing_groups_fail else F.lit(0)
    verdict = F.when(a > b, a - b).when(a == b, 1).otherwise(absent)
    return _counts_side_by_side(df, other, list(group_by)).withColumn(FAILURES, verdict.cast("long"))


def columns_match(df: DataFrame, expected: list[str], transform: Callable[[str], str] = str.upper) -> DataFrame:
    """Column names present on one side only."""
    have, want = {transform(c) for c in df.columns}, {transform(c) for c in expected}
    rows = [(c, None) for c in sorted(have - want)] + [(None, c) for c in sorted(want - have)]
    return df.sparkSession.createDataFrame(rows, "relation_column string, input_column string")


# --- suites ----------------------------------------------------------------------------------------------------


def failure_count(failing: DataFrame) -> Column:
    """Number of failures as an aggregate over the rows of a test."""
    if FAILURES in failing.columns:
        return F.coalesce(F.sum(F.coalesce(F.col(FAILURES), F.lit(0))), F.lit(0)).cast("long")
    return F.count("*")


@dataclass
class Check:
    """A test bound to its table: `rule(table, **options)` lists the offending rows."""

    name: str
    table: DataFrame
    rule: Callable[..., DataFrame]
    options: dict = field(default_factory=dict)
    where: str | None = None
    error_if: str = "> 0"
    warn_if: str = "> 0"
    severity: str = "error"

    def result(self) -> DataFrame:
        source = self.table.filter(self.where) if self.where else self.table
        failing = self.rule(source, **self.options)
        counted = failing.agg(failure_count(failing).alias(FAILURES))
        return counted.select(F.lit(self.name).alias("test"), FAILURES, _status(self).alias("status"))


def _status(check: Check) -> Column:
    """'error', 'warn' or 'pass' from the `failures` column."""
    status = F.when(F.expr(f"{FAILURES} {check.warn_if}"), "warn").otherwise("pass")
    if check.severity != "error":
        return status
    return F.when(F.expr(f"{FAILURES} {check.error_if}"), "error").otherwise(status)


@dataclass
class Shared:
    """A check as part of a grouping that it shares with others: aggregates for each group, and the failures of a group
    from their values. A check that only adds up rows fits any grouping."""

    keys: tuple[str, ...]
    aggregates: list[Column]
    failures: Callable[..., Column]
    additive: bool = False


def _within(scope: Column | None, value: Column) -> Column:
    return value if scope is None else F.when(scope, value)


def _rows(scope: Column | None, condition: Column | None = None) -> Column:
    """Number of rows in scope that meet a condition."""
    held = [c for c in (scope, condition) if c is not None]
    return F.count_if(reduce(lambda a, b: a & b, held)) if held else F.count("*")


def _one_if(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0).cast("long")


_ROW_RULES: dict[Callable, Callable[..., Column]] = {
    not_null: _is_null,
    accepted_range: _out_of_range,
    expression_is_true: _untrue,
    assert_equal: _unequal,
    not_empty_string: _empty,
    accepted_values: _outside,
}


def shared_form(check: Check) -> Shared | None:
    """The check as part of a grouping; None for rules over neighbours or a second table, which need plans of their own."""
    scope = F.expr(check.where) if check.where else None
    o = dict(check.options)
    if check.rule in _ROW_RULES:
        return Shared((), [_rows(scope, _ROW_RULES[check.rule](**o))], lambda n: n, additive=True)
    if check.rule is unique:
        return Shared((o["column"],), [_rows(scope, F.col(o["column"]).isNotNull())], lambda n: _one_if(n > 1))
    if check.rule is unique_combination:
        return Shared(tuple(o["columns"]), [_rows(scope)], lambda n: _one_if(n > 1))
    keys, column = tuple(o.get("group_by", ())), o.get("column")
    if check.rule is at_least_one:
        counts = [_rows(scope, F.col(column).isNotNull()), _rows(scope)]
        return Shared(keys, counts, lambda n, rows: _one_if((n == 0) & (rows > 0 if keys else F.lit(True))))
    if check.rule is not_constant:
        value = _within(scope, F.col(column))
        return Shared(keys, [F.min(value), F.max(value)], lambda low, high: _one_if(low == high))
    if check.rule is not_null_proportion:
        filled = F.avg(_within(scope, F.when(F.col(column).isNotNull(), 1.0).otherwise(0.0)))
        most = o.get("at_most", 1.0)
        return Shared(keys, [filled], lambda share: _one_if((share < o["at_least"]) | (share > most)))
    if check.rule is recency:
        kind = "date" if o.get("ignore_time") else "timestamp"
        limit = F.timestamp_add(o["part"].upper(), F.lit(-o["interval"]), as_of_column(o.get("as_of"))).cast(kind)
        newest = F.max(_within(scope, F.col(column)))
        return Shared(keys, [newest], lambda n: _one_if(n.cast(kind) < limit))
    return None


def _grouped_results(table: DataFrame, keys: tuple[str, ...], checks: list[tuple[Check, Shared]]) -> DataFrame:
    """Results of all checks of one grouping of a table: one scan, whatever their number."""
    named = [[a.alias(f"c{i}_{j}") for j, a in enumerate(s.aggregates)] for i, (_, s) in enumerate(checks)]
    groups = table.groupBy(*[F.col(k).alias(f"_key_{n}") for n, k in enumerate(keys)]).agg(*[a for own in named for a in own])
    failures = [
        s.failures(*[F.col(f"c{i}_{j}") for j in range(len(s.aggregates))]).cast("long") for i, (_, s) in enumerate(checks)
    ]
    counts = groups.agg(*[F.coalesce(F.sum(f), F.lit(0)).alias(f"f{i}") for i, f in enumerate(failures)])
    per_check = [
        F.struct(F.lit(c.name).alias("test"), F.col(f"f{i}").alias(FAILURES), F.lit(i).alias("i"))
        for i, (c, _) in enumerate(checks)
    ]
    rows = counts.select(F.explode(F.array(*per_check)).alias("c")).select("c.*")
    status = reduce(
        lambda rest, ic: F.when(F.col("i") == ic[0], _status(ic[1][0])).otherwise(rest), enumerate(checks), F.lit("")
    )
    return rows.select("test", FAILURES, status.alias("status"))


def groupings(checks: list[Check]) -> tuple[list[tuple[DataFrame, tuple[str, ...], list[tuple[Check, Shared]]]], list[Check]]:
    """The groupings that answer the checks, and the checks that no grouping can answer.

    Checks of a table on equal keys share a grouping. Those that only add up rows join the first grouping of their table,
    so a table is scanned once for each set of keys, and once if there is none.
    """
    found: dict[tuple, tuple[DataFrame, tuple[str, ...], list]] = {}
    additive, alone = [], []
    for check in checks:
        form = shared_form(check)
        if form is None:
            alone.append(check)
        elif form.additive:
            additive.append((check, form))
        else:
            found.setdefault((id(check.table), form.keys), (check.table, form.keys, []))[2].append((check, form))
    for check, form in additive:
        place = next((k for k in found if k[0] == id(check.table)), (id(check.table), ()))
        found.setdefault(place, (check.table, (), []))[2].append((check, form))
    return list(found.values()), alone


def run_suite(checks: list[Check]) -> DataFrame:
    """One row per check: name, failures, status; one grouping of a table answers all its checks on the same keys."""
    shared, alone = groupings(checks)
    parts = [_grouped_results(*g) for g in shared] + [check.result() for check in alone]
    return reduce(DataFrame.unionByName, parts)


def model_suite(raw: DataFrame, stg: DataFrame, latest: DataFrame, summary: DataFrame, candles: DataFrame) -> list[Check]:
    """The declared tests of the log and its models."""
    checks = [Check(f"raw_not_null_{c}", raw, not_null, {"column": c}) for c in ("time", "symbol", "price")]
    checks += [Check(f"stg_not_null_{c}", stg, not_null, {"column": c}) for c in ("time", "symbol", "price")]
    keyed = (("latest", latest, ["symbol", "latest_price", "last_updated"], "symbol"),
             ("summary", summary, ["window_id", "window_start", "window_end", "symbol"], "window_id"),
             ("candles", candles, ["period_key", "period_start", "symbol"], "period_key"))
    for name, table, required, key in keyed:
        checks += [Check(f"{name}_not_null_{c}", table, not_null, {"column": c}) for c in required]
        checks.append(Check(f"{name}_unique_{key}", table, unique, {"column": key}))
    return checks

