"""Statistical summary per symbol and window."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.functions.numbers import change_pct, share_pct
from candlewick.functions.text import period_key
from candlewick.functions.times import arrival_order, as_of_column, bucket_start, micros, plus
from candlewick.plans.candles import WIDTH

# Least number of updates per activity level.
ACTIVITY_LEVELS = ((100, "Very High"), (50, "High"), (20, "Medium"), (5, "Low"))


def activity_level(updates):
    level = F.lit("Very Low")
    for least, name in reversed(ACTIVITY_LEVELS):
        level = F.when(updates >= least, F.lit(name)).otherwise(level)
    return level


MARKED_SECONDS = 3600  # widest window whose seconds are marked as bits


def seconds_seen(width: str) -> list[Column]:
    """Aggregates that mark each second of a window by one bit, 60 to a long integer."""
    seconds = -(-micros(width) // 1_000_000)
    offset = F.pmod(F.unix_seconds("time"), F.lit(seconds))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(offset, F.lit(60)).cast("int"))
    return [F.bit_or(F.when(F.floor(offset / 60) == word, bit)) for word in range(-(-seconds // 60))]


def price_summary(stg: DataFrame, as_of=None, width: str = WIDTH) -> DataFrame:
    """26 columns per (window, symbol).

    Averages of prices are exact decimals. First and last price are order-based aggregates, so the window is read once.
    Seconds with updates are marked as bits of a few long integers, which a hash aggregate can combine. Windows above an
    hour would need a long integer for each of their minutes; they count distinct seconds, in two aggregate levels
    (window, symbol, second, then window, symbol), so a day has no more aggregates than a quarter of an hour.
    """
    order = arrival_order()
    marked = micros(width) <= MARKED_SECONDS * 1_000_000
    seen = [w.alias(f"_seen_{i}") for i, w in enumerate(seconds_seen(width))] if marked else [
        F.count_distinct(F.unix_seconds("time")).alias("unique_seconds_with_updates")
    ]
    grouped = stg.groupBy(bucket_start("time", width).alias("window_start"), "symbol").agg(
        F.min("price").alias("min_price"),
        F.max("price").alias("max_price"),
        F.avg("price").alias("avg_price"),
        F.stddev_samp(F.col("price").cast("double")).alias("price_stddev"),
        F.sum("volume").alias("total_volume"),
        F.avg("volume").alias("avg_volume"),
        F.avg("bid").alias("avg_bid"),
        F.avg("ask").alias("avg_ask"),
        F.avg("spread").alias("avg_spread"),
        F.avg("spread_pct").alias("avg_spread_pct"),
        F.max("spread").alias("max_spread"),
        F.count("*").alias("update_count"),
        *seen,
        F.min_by("price", order).alias("first_price"),
        F.max_by("price", order).alias("last_price"),
    )
    c = F.col
    if marked:
        bits = [F.coalesce(F.bit_count(f"_seen_{i}"), F.lit(0)).cast("long") for i in range(len(seen))]
        grouped = grouped.withColumn("unique_seconds_with_updates", reduce(lambda a, b: a + b, bits))
    return grouped.select(
        period_key("window_start", "symbol").alias("window_id"),
        "window_start",
        plus(c("window_start"), width).alias("window_end"),
        "symbol",
        "min_price",
        "max_price",
        "avg_price",
        "price_stddev",
        "total_volume",
        "avg_volume",
        "avg_bid",
        "avg_ask",
        "avg_spread",
        "avg_spread_pct",
        "max_spread",
        "update_count",
        "unique_seconds_with_updates",
        F.round(share_pct(c("unique_seconds_with_updates"), c("update_count")), 2).alias("update_distribution_pct"),
        (c("max_price") - c("min_price")).alias("price_range"),
        change_pct(c("max_price"), c("min_price")).alias("price_range_percentage"),
        share_pct(c("price_stddev"), c("avg_price")).alias("coefficient_of_variation"),
        "first_price",
        "last_price",
        change_pct(c("last_price"), c("first_price")).alias("period_return_percentage"),
        activity_level(c("update_count")).alias("activity_level"),
        as_of_column(as_of).alias("updated_at"),
    )
