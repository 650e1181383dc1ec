"""Time buckets, durations and orderings as columns."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

_UNITS = {
    "second": 1_000_000,
    "minute": 60_000_000,
    "hour": 3_600_000_000,
    "day": 86_400_000_000,
}


def micros(span: str) -> int:
    """'15 minutes' -> 900000000."""
    count, unit = span.strip().lower().split()
    return int(count) * _UNITS[unit.rstrip("s")]


def bucket_start(time: Column | str, width: str) -> Column:
    """Start of the epoch-aligned bucket holding `time` (UTC wall clock)."""
    us = F.unix_micros(time)
    return F.timestamp_micros(us - F.pmod(us, F.lit(micros(width))))


def plus(time: Column, span: str, times: int = 1) -> Column:
    return F.timestamp_micros(F.unix_micros(time) + F.lit(micros(span) * times))


def as_of_column(as_of) -> Column:
    """The moment a relative filter counts from; None means now."""
    if as_of is None:
        return F.current_timestamp()
    return as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp")


def seconds_between(later: Column, earlier: Column) -> Column:
    return (F.unix_micros(later) - F.unix_micros(earlier)) / F.lit(1_000_000.0)


def arrival_order(time: Column | str = "time", tiebreak: Column | str = "id") -> Column:
    """`time`, then `tiebreak`, packed into one decimal.

    min_by/max_by on a struct ordering force a sort-based aggregate, because a struct cannot be updated in place in
    the hash map; a decimal(38,0) can, so the aggregate stays hash-based. The factor exceeds the span of a long.
    Rows without a tiebreak still have their time: min_by and max_by would skip a NULL order.
    """
    tie = F.coalesce(F.col(tiebreak) if isinstance(tiebreak, str) else tiebreak, F.lit(0))
    return F.unix_micros(time).cast("decimal(18,0)") * F.lit(Decimal(10**20)).cast("decimal(21,0)") + tie.cast("decimal(20,0)")
