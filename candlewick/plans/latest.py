"""Latest price per symbol with 24-hour context."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.functions.numbers import change, change_pct
from candlewick.functions.times import arrival_order, as_of_column, micros, plus
from candlewick.operators.asof import as_of
from candlewick.sources.log import on_days


def _statistics() -> list[Column]:
    return [
        F.min("price").alias("min_price_24h"),
        F.max("price").alias("max_price_24h"),
        F.avg("price").alias("avg_price_24h"),
        F.sum("volume").alias("volume_24h"),
        F.count("*").alias("updates_24h"),
    ]


def last_day(stg: DataFrame, as_of=None, lookback: str = "24 hours") -> DataFrame:
    now = as_of_column(as_of)
    first = plus(now, lookback, -1)
    return on_days(stg.filter((F.col("time") >= first) & (F.col("time") <= now)), first, now)


def stats_24h(stg: DataFrame, as_of=None) -> DataFrame:
    return last_day(stg, as_of).groupBy("symbol").agg(*_statistics())


def nearest_price(stg: DataFrame, as_of=None, back: str = "24 hours", tolerance: str = "1 hour") -> DataFrame:
    """Price closest in time to `as_of - back`, within the tolerance on either side; the earlier tick wins a tie."""
    target = plus(as_of_column(as_of), back, -1)
    first, last = plus(target, tolerance, -1), plus(target, tolerance)
    near = on_days(stg.filter(F.col("time").between(first, last)), first, last)
    distance = F.abs(F.unix_micros("time") - F.unix_micros(target))
    best = F.min_by(F.struct("price", "time"), F.struct(distance, "time", "id"))
    return (
        near.groupBy("symbol")
        .agg(best.alias("best"))
        .select("symbol", F.col("best.price").alias("price_24h_ago"), F.col("best.time").alias("price_time"))
    )


def earlier_prices(stg: DataFrame, back: str = "24 hours", tolerance: str = "1 hour", slices: int | None = None) -> DataFrame:
    """Every tick with the price closest in time to `back` before it, found as `nearest_price` finds it for one moment.

    Columns: id, time, symbol, price, earlier_price, earlier_time, change and change_pct.
    """
    moment = F.unix_micros("time")
    asked = stg.select("id", "time", "symbol", "price", (moment - micros(back)).alias("_asked_at"))
    facts = stg.select("symbol", "id", "price", "time", moment.alias("_told_at"))
    columns = {"price": "earlier_price", "time": "earlier_time"}
    found = as_of(asked, facts, ["symbol"], "_asked_at", "_told_at", columns, "nearest", micros(tolerance), "id", slices)
    price, base = F.col("price"), F.col("earlier_price")
    return found.drop("_asked_at").withColumns({"change": change(price, base), "change_pct": change_pct(price, base)})


def latest_prices(stg: DataFrame, as_of=None) -> DataFrame:
    """19 columns, one row per symbol seen in the last 24 hours.

    Statistics, the newest time and the day-old price come out of one hash aggregate over 25 hours, each looking at its
    own part of them: orders are packed into decimals, because a struct would force a sort of all rows. The rows of the
    newest instants, a few for each symbol, are then fetched by symbol and time.
    """
    now = as_of_column(as_of)
    day_ago = plus(now, "24 hours", -1)
    first = plus(day_ago, "1 hour", -1)
    scan = on_days(stg.filter((F.col("time") >= first) & (F.col("time") <= now)), first, now)
    in_day = F.col("time") >= day_ago
    row = F.struct("price", "volume", "bid", "ask", "spread", "spread_pct", "exchange", "time", "inserted_at")
    apart = F.unix_micros("time") - F.unix_micros(day_ago)
    nearness = F.timestamp_micros(F.abs(apart) * 2 + (apart > 0).cast("long"))  # of two equally far the earlier is nearer
    near = F.when(F.abs(apart) <= micros("1 hour"), arrival_order(nearness))

    def daily(column: str) -> Column:
        return F.when(in_day, F.col(column))

    grouped = scan.groupBy("symbol").agg(
        F.max(daily("time")).alias("last_time"),
        F.min_by("price", near).alias("price_24h_ago"),
        F.min(daily("price")).alias("min_price_24h"),
        F.max(daily("price")).alias("max_price_24h"),
        F.avg(daily("price")).alias("avg_price_24h"),
        F.sum(daily("volume")).alias("volume_24h"),
        F.count_if(in_day).alias("updates_24h"),
    )
    seen = grouped.filter("updates_24h > 0")
    newest = on_days(stg.filter((F.col("time") >= day_ago) & (F.col("time") <= now)), day_ago, now)
    instants = seen.select(F.col("symbol").alias("_symbol"), F.col("last_time").alias("_time"))
    at_last = newest.join(instants, F.col("symbol").eqNullSafe(F.col("_symbol")) & (F.col("time") == F.col("_time")))
    lasts = at_last.groupBy("_symbol").agg(F.max_by(row, F.struct("inserted_at", "id")).alias("last"))
    price, base = F.col("last.price"), F.col("price_24h_ago")
    return seen.join(lasts, F.col("symbol").eqNullSafe(F.col("_symbol"))).select(
        "symbol",
        price.alias("latest_price"),
        F.col("last.volume").alias("latest_volume"),
        F.col("last.bid").alias("latest_bid"),
        F.col("last.ask").alias("latest_ask"),
        F.col("last.spread").alias("spread"),
        F.col("last.spread_pct").alias("spread_percentage"),
        "price_24h_ago",
        change(price, base).alias("price_change_24h"),
        change_pct(price, base).alias("price_change_pct_24h"),
        "min_price_24h",
        "max_price_24h",
        "avg_price_24h",
        "volume_24h",
        "updates_24h",
        F.col("last.exchange").alias("exchange"),
        F.col("last.time").alias("last_updated"),
        F.col("last.inserted_at").alias("last_inserted_at"),
        now.alias("refreshed_at"),
    )
