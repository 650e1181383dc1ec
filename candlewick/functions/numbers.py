"""Null- and zero-safe arithmetic."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def safe_add(*terms: Column | str) -> Column:
    """Sum with NULL counted as 0."""
    return reduce(lambda a, b: a + b, [F.coalesce(_column(t), F.lit(0)) for t in terms])


def safe_subtract(*terms: Column | str) -> Column:
    """First term minus all others, NULL counted as 0."""
    return reduce(lambda a, b: a - b, [F.coalesce(_column(t), F.lit(0)) for t in terms])


def safe_divide(numerator: Column | str, denominator: Column | str) -> Column:
    """NULL instead of an error when the denominator is 0."""
    return _column(numerator) / F.nullif(_column(denominator), F.lit(0))


def change(current: Column, base: Column) -> Column:
    """Absolute change, NULL unless the base is positive."""
    return F.when(base > 0, current - base)


def change_pct(current: Column, base: Column) -> Column:
    """Change in percent of a positive base, as a double."""
    return F.when(base > 0, (current - base).cast("double") / base.cast("double") * 100)


def share_pct(part: Column, whole: Column) -> Column:
    """Part of a positive whole in percent, as a double."""
    return F.when(whole > 0, part.cast("double") / whole.cast("double") * 100)


def bucket_number(value: Column | str, low, high, buckets) -> Column:
    """Equal-width bucket 1..n; 0 below `low`, n+1 from `high` on."""
    def bound(x):
        return x if isinstance(x, Column) else F.lit(x)

    return F.width_bucket(
        _column(value).cast("double"), bound(low).cast("double"), bound(high).cast("double"), bound(buckets).cast("long")
    )


def to_mebibytes(size: Column) -> Column:
    return size.cast("double") / 1024 / 1024
