"""Pivot, unpivot, union by name, distinct values."""

from __future__ import annotations

import operator
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.functions.text import slug_name
from candlewick.operators.columns import columns_except

_COMPARE = {
    "=": operator.eq,
    "!=": operator.ne,
    "<>": operator.ne,
    "<": operator.lt,
    "<=": operator.le,
    ">": operator.gt,
    ">=": operator.ge,
    "like": lambda column, value: column.like(value),
}
_AGGREGATES = {"sum": F.sum, "max": F.max, "min": F.min, "avg": F.avg, "count": F.count}
_DISTINCT = {"sum": F.sum_distinct, "count": F.count_distinct}


MOST_COLUMNS = 1000  # that a pivot looks up by itself


def value_counts(df: DataFrame, column: str, where: str | None = None) -> DataFrame:
    """Distinct values of a column with their frequency; stays a table, however many there are."""
    source = df.filter(where) if where else df
    return source.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("row_count"))


def column_values(
    df: DataFrame,
    column: str,
    where: str | None = None,
    max_records: int | None = None,
    default: list | None = None,
    order_by: str = "row_count desc, value",
) -> list:
    """Distinct values as a Python list, most frequent first, for callers that need them on the driver.

    `max_records` takes that many of them, as a LIMIT does; without it all come. `order_by` may name `value`,
    `row_count` and any SQL over them. `default` is returned when there are none.
    """
    ranked = _ordered(value_counts(df, column, where), order_by)
    rows = (ranked if max_records is None else ranked.limit(max_records)).collect()
    return [r["value"] for r in rows] or (default if default is not None else [])


def _ordered(df: DataFrame, order_by: str) -> DataFrame:
    """ORDER BY as SQL text, with directions."""
    keys = []
    for part in order_by.split(","):
        words = part.split()
        down = words[-1].lower() == "desc"
        key = F.expr(" ".join(words[:-1] if words[-1].lower() in ("asc", "desc") else words))
        keys.append(key.desc() if down else key.asc())
    return df.orderBy(*keys)


def pivot_columns(
    column: str,
    values: list,
    agg: str = "sum",
    compare: str = "=",
    then_value: Any = 1,
    else_value: Any = 0,
    prefix: str = "",
    suffix: str = "",
    distinct: bool = False,
    slug_alias: bool = False,
) -> list[Column]:
    """One conditional aggregate per value, for use in `groupBy(...).agg(*...)`; absent pairs give `else_value`."""

    def operand(value: Any) -> Column:
        return value if isinstance(value, Column) else F.lit(value)

    result = []
    for value in values:
        picked = F.when(_COMPARE[compare](F.col(column), value), operand(then_value)).otherwise(operand(else_value))
        fold = _DISTINCT.get(agg, _AGGREGATES[agg]) if distinct else _AGGREGATES[agg]
        total = fold(picked)
        name = f"{prefix}{value}{suffix}"
        result.append(total.alias(slug_name(name) if slug_alias else name))
    return result


def pivot(df: DataFrame, by: list[str], column: str, values: list | None = None, most: int = MOST_COLUMNS, **options) -> DataFrame:
    """One column for each value of `column`. Without `values` they are looked up, and more than `most` raise ValueError:
    a plan cannot have a column for each value of a column that grows with the data."""
    chosen = column_values(df, column, max_records=most + 1) if values is None else values
    if values is None and len(chosen) > most:
        raise ValueError(f"{column} has more than {most} values; name those that shall be columns")
    return df.groupBy(*by).agg(*pivot_columns(column, chosen, **options))


def unpivot(
    df: DataFrame,
    keep: list[str] = (),
    remove: list[str] = (),
    cast_to: str = "string",
    field_name: str = "field_name",
    value_name: str = "value",
) -> DataFrame:
    """Columns to rows. `keep` columns repeat on every row, `remove` columns vanish; NULL values keep their row."""
    kept = {c.lower() for c in keep}
    melted = [c for c in columns_except(df, remove) if c.lower() not in kept]
    narrow = df.select(*keep, *[F.col(f"`{c}`").cast(cast_to).alias(c) for c in melted])
    return narrow.unpivot([F.col(c) for c in keep], melted, field_name, value_name)


def union_relations(
    relations: dict[str, DataFrame],
    include: list[str] = (),
    exclude: list[str] = (),
    types: dict[str, T.DataType | str] | None = None,
    source_column: str | None = "source_relation",
    where: str | None = None,
) -> DataFrame:
    """Union by name over the superset of columns; a column a relation lacks is NULL there."""
    if include and exclude:
        raise ValueError("give include or exclude, not both")
    wanted, unwanted = {c.lower() for c in include}, {c.lower() for c in exclude}
    parts = []
    for name, df in relations.items():
        source = df.filter(where) if where else df
        columns = [c for c in df.columns if c.lower() not in unwanted and (not wanted or c.lower() in wanted)]
        casts = [F.col(c).cast((types or {})[c]).alias(c) if c in (types or {}) else F.col(c) for c in columns]
        label = [F.lit(name).alias(source_column)] if source_column else []
        parts.append(source.select(*label, *casts))
    united = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    if not columns_except(united, [source_column] if source_column else []):
        raise ValueError("no columns left to union")
    return united


def single_value(df: DataFrame, default: Any = None) -> Any:
    """First column of the first row, or `default` when there is no row."""
    row = df.first()
    return default if row is None else row[0]


def results_as_columns(df: DataFrame, order_by: list[str], max_rows: int | None = None) -> DataFrame:
    """A small query result as one row holding one array per column, ordered by `order_by`.

    Meant for lookups, as the whole result becomes one row; with `max_rows` more rows than that raise an error.
    """
    ordered = F.array_sort(F.collect_list(F.struct(*order_by, *[F.col(c).alias(f"v_{c}") for c in df.columns])))
    whole = df.agg(ordered.alias("rows"))
    if max_rows is not None:
        message = F.concat(F.lit(f"more than {max_rows} rows: "), F.size("rows").cast("string"))
        checked = F.when(F.size("rows") <= max_rows, F.col("rows")).otherwise(F.raise_error(message))
        whole = whole.select(checked.alias("rows"))
    return whole.select([F.col(f"rows.v_{c}").alias(c) for c in df.columns])
