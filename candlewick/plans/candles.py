"""Open-high-low-close candles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewick.functions.text import period_key
from candlewick.functions.times import arrival_order, bucket_start

WIDTH = "15 minutes"


def ohlc() -> list[Column]:
    """Open, high, low, close; ticks of one instant are ordered by id."""
    order = arrival_order()
    return [
        F.min_by("price", order).alias("open"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        F.max_by("price", order).alias("close"),
    ]


def candles(ticks: DataFrame, width: str = WIDTH) -> DataFrame:
    """One row per symbol and period. One shuffle, combined on the map side, so a hot symbol costs no more."""
    return (
        ticks.groupBy(bucket_start("time", width).alias("period_start"), "symbol")
        .agg(*ohlc(), F.sum("volume").alias("total_volume"), F.count("*").alias("trade_count"))
        .select(
            period_key("period_start", "symbol").alias("period_key"),
            "period_start",
            "symbol",
            "open",
            "high",
            "low",
            "close",
            "total_volume",
            "trade_count",
        )
    )


def candles_by(ticks: DataFrame, keys: tuple[str, ...] = ("symbol", "exchange"), width: str = WIDTH) -> DataFrame:
    """Candles with average and sample deviation per bucket and `keys`."""
    return ticks.groupBy(bucket_start("time", width).alias("bucket"), *keys).agg(*trade_statistics())


def trade_statistics() -> list[Column]:
    return [
        *ohlc(),
        F.sum("volume").alias("volume"),
        F.count("*").alias("num_trades"),
        F.avg("price").alias("avg_price"),
        F.stddev_samp(F.col("price").cast("double")).alias("price_stddev"),
    ]


def candles_windowed(ticks: DataFrame, width: str = WIDTH, salts: int = 16) -> DataFrame:
    """The same candles by window functions: frame over the whole period, then keep one row.

    Two rounds: the first runs per (period, symbol, salt), so a hot period is shared by `salts` tasks; the second
    merges at most `salts` rows per period.
    """
    rows = ticks.select(
        bucket_start("time", width).alias("period_start"),
        "symbol",
        arrival_order().alias("first_at"),
        arrival_order().alias("last_at"),
        F.col("price").alias("open"),
        F.col("price").alias("high"),
        F.col("price").alias("low"),
        F.col("price").alias("close"),
        F.col("volume").alias("total_volume"),
        F.lit(1).cast("long").alias("trade_count"),
        F.pmod(F.xxhash64("id"), F.lit(salts)).alias("salt"),
    )
    for keys in (["period_start", "symbol", "salt"], ["period_start", "symbol"]):
        by_first = Window.partitionBy(*keys).orderBy("first_at")
        whole = by_first.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        ranked = rows.select(
            *keys,
            F.first("first_at").over(whole).alias("first_at"),
            F.max("last_at").over(whole).alias("last_at"),
            F.first("open").over(whole).alias("open"),
            F.max("high").over(whole).alias("high"),
            F.min("low").over(whole).alias("low"),
            F.max_by("close", "last_at").over(whole).alias("close"),
            F.sum("total_volume").over(whole).alias("total_volume"),
            F.sum("trade_count").over(whole).alias("trade_count"),
            F.row_number().over(by_first).alias("rn"),
        )
        rows = ranked.filter("rn = 1").drop("rn")
    return rows.select(
        period_key("period_start", "symbol").alias("period_key"), *[c for c in rows.columns if not c.endswith("_at")]
    )


def rollup(base: DataFrame, width: str) -> DataFrame:
    """Wider candles from narrower ones (columns of `candles`)."""
    return (
        base.groupBy(bucket_start("period_start", width).alias("bucket"), "symbol")
        .agg(
            F.min_by("open", "period_start").alias("open"),
            F.max("high").alias("high"),
            F.min("low").alias("low"),
            F.max_by("close", "period_start").alias("close"),
            F.sum("total_volume").alias("total_volume"),
            F.sum("trade_count").alias("trade_count"),
        )
        .withColumnRenamed("bucket", "period_start")
    )
