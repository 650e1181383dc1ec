"""Column selection and column-wise cleaning."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.functions.text import blank_to_null


def columns_except(df: DataFrame, exclude: list[str] = ()) -> list[str]:
    """Column names without `exclude`, compared case-insensitively."""
    unwanted = {c.lower() for c in exclude}
    return [c for c in df.columns if c.lower() not in unwanted]


def star(df: DataFrame, exclude: list[str] = (), prefix: str = "", suffix: str = "") -> DataFrame:
    """All columns but `exclude`, optionally renamed to prefix + name + suffix."""
    return df.select([F.col(f"`{c}`").alias(f"{prefix}{c}{suffix}") for c in columns_except(df, exclude)])


def nullcheck(df: DataFrame, columns: list[str]) -> DataFrame:
    """Blank text becomes NULL in the named columns; all other columns are dropped."""
    types = {f.name: f.dataType for f in df.schema}
    return df.select(
        [(blank_to_null(c) if isinstance(types[c], T.StringType) else F.col(c)).alias(c) for c in columns]
    )


def nullcheck_table(df: DataFrame) -> DataFrame:
    return nullcheck(df, df.columns)


def group_by_first(df: DataFrame, n: int, *aggregates) -> DataFrame:
    """Group by the first n columns."""
    return df.groupBy(*df.columns[:n]).agg(*aggregates)
