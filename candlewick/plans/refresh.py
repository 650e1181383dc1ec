"""Incremental models and the continuously refreshed candle table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.functions.times import as_of_column, bucket_start, micros, plus
from candlewick.plans.candles import WIDTH, candles, candles_by
from candlewick.plans.summary import price_summary
from candlewick.sources.log import DAY, day_folders, on_days, path_exists, upsert


def changed_since(ticks: DataFrame, high_water, lookback: str) -> DataFrame:
    """Ticks from `high_water - lookback` on; high_water is a plain value, so the filter reaches the scan."""
    first = plus(F.lit(high_water).cast("timestamp"), lookback, -1)
    return on_days(ticks.filter(F.col("time") >= first), first)


def high_water(spark: SparkSession, path: str, column: str):
    """Newest window start of a table, None while it has no row. Only the newest day is read."""
    days = day_folders(spark, path) if path_exists(spark, path) else {}
    if not days:
        return None
    last_day = spark.read.parquet(path).filter(F.col(DAY) == F.lit(max(days)))
    return last_day.agg(F.max(column)).first()[0]


def run_incremental(
    ticks: DataFrame,
    path: str,
    model: Callable[[DataFrame], DataFrame],
    start: str,
    key: str,
    lookback: str,
    full_refresh: bool = False,
) -> None:
    """Bring a windowed table up to date.

    The lookback counts from the start of the newest window and is a multiple of the width, so every recomputed
    window sees all its ticks. A tick later than the lookback is left for a full refresh. A table without rows is
    loaded in full.
    """
    newest = None if full_refresh else high_water(ticks.sparkSession, path, start)
    source = ticks if newest is None else changed_since(ticks, newest, lookback)
    batch = model(source).withColumn(DAY, F.to_date(start))
    upsert(batch, path, [DAY, key], full_refresh=newest is None)


def refresh_candles(stg: DataFrame, path: str, width: str = WIDTH, lookback: str = "1 hour", **options) -> None:
    run_incremental(stg, path, lambda t: candles(t, width), "period_start", "period_key", lookback, **options)


def refresh_summary(
    stg: DataFrame, path: str, as_of=None, width: str = WIDTH, lookback: str = "2 hours", **options
) -> None:
    model = lambda t: price_summary(t, as_of, width)
    run_incremental(stg, path, model, "window_start", "window_id", lookback, **options)


def refresh_range(
    ticks: DataFrame,
    path: str,
    as_of=None,
    start_offset: str = "2 hours",
    end_offset: str = "1 minute",
    width: str = WIDTH,
    keys: tuple[str, ...] = ("symbol", "exchange"),
) -> None:
    """Recompute the buckets that lie wholly inside [as_of - start_offset, as_of - end_offset]."""
    now = as_of_column(as_of)
    begin, end = plus(now, start_offset, -1), plus(now, end_offset, -1)
    first = bucket_start(plus(begin, f"{micros(width) // 1_000_000} seconds") - F.expr("INTERVAL 1 MICROSECOND"), width)
    last = bucket_start(end, width)
    inside = on_days(ticks.filter((F.col("time") >= first) & (F.col("time") < last)), first, last)
    batch = candles_by(inside, keys, width).withColumn(DAY, F.to_date("bucket"))
    upsert(batch, path, [DAY, "bucket", *keys])


def realtime_candles(
    ticks: DataFrame, path: str, width: str = WIDTH, keys: tuple[str, ...] = ("symbol", "exchange")
) -> DataFrame:
    """Stored candles below the newest stored bucket, fresh ones from it on; all fresh while none is stored."""
    spark = ticks.sparkSession
    found = high_water(spark, path, "bucket")
    if found is None:
        return candles_by(ticks, keys, width)
    newest = F.lit(found).cast("timestamp")
    stored = spark.read.parquet(path).filter(F.col("bucket") < newest).drop(DAY)
    live = candles_by(on_days(ticks.filter(F.col("time") >= newest), newest), keys, width)
    return stored.unionByName(live)
