"""Analytic queries over the latest-price and summary models."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.functions.times import as_of_column, plus, seconds_between

MINUTE, SLOT, SECOND = "yyyy-MM-dd HH:mm", "HH:mm", "yyyy-MM-dd HH:mm:ss"


def _since(df: DataFrame, column: str, lookback: str, as_of) -> DataFrame:
    return df.filter(F.col(column) >= plus(as_of_column(as_of), lookback, -1))


def _r(column: Column | str, digits: int = 2) -> Column:
    """Rounded as an exact decimal, so that halves always go up."""
    value = F.col(column) if isinstance(column, str) else column
    return F.round(value.cast("decimal(38,12)"), digits)


def current_prices(latest: DataFrame) -> DataFrame:
    return latest.select(
        "symbol",
        _r("latest_price").alias("current_price"),
        _r("price_change_pct_24h").alias("change_24h_pct"),
        _r("volume_24h").alias("total_volume_24h"),
        _r("spread_percentage", 4).alias("spread_pct"),
        F.date_format("last_updated", SECOND).alias("last_update"),
    ).orderBy("symbol")


def top_gainers(latest: DataFrame, n: int = 5) -> DataFrame:
    rising = latest.filter("price_change_pct_24h > 0").orderBy(F.desc("price_change_pct_24h"), "symbol").limit(n)
    return rising.select("symbol", _r("latest_price").alias("price"), _r("price_change_pct_24h").alias("gain_pct"))


def top_losers(latest: DataFrame, n: int = 5) -> DataFrame:
    falling = latest.filter("price_change_pct_24h < 0").orderBy("price_change_pct_24h", "symbol").limit(n)
    return falling.select("symbol", _r("latest_price").alias("price"), _r("price_change_pct_24h").alias("loss_pct"))


def most_active(latest: DataFrame, n: int = 10) -> DataFrame:
    busiest = latest.orderBy(F.desc("updates_24h"), "symbol").limit(n)
    return busiest.select(
        "symbol", "updates_24h", _r("volume_24h").alias("total_volume_24h"), _r("latest_price").alias("current_price")
    )


def symbol_windows(summary: DataFrame, symbol: str, lookback: str = "2 hours", as_of=None) -> DataFrame:
    rows = _since(summary.filter(F.col("symbol") == symbol), "window_start", lookback, as_of)
    return rows.orderBy(F.desc("window_start")).select(
        F.date_format("window_start", MINUTE).alias("period"),
        "symbol",
        _r("min_price").alias("low"),
        _r("avg_price").alias("average"),
        _r("max_price").alias("high"),
        _r("price_range_percentage").alias("volatility_pct"),
        F.col("update_count").alias("updates"),
        "activity_level",
    )


def most_volatile(
    summary: DataFrame, lookback: str = "1 hour", as_of=None, least_pct: float = 0.5, n: int = 10
) -> DataFrame:
    moving = _since(summary, "window_start", lookback, as_of).filter(F.col("price_range_percentage") > least_pct)
    top = moving.orderBy(F.desc("price_range_percentage"), "window_start", "symbol").limit(n)
    return top.select(
        F.date_format("window_start", MINUTE).alias("period"),
        "symbol",
        _r("price_range_percentage").alias("price_range_pct"),
        _r("coefficient_of_variation").alias("cv_pct"),
        "activity_level",
    )


def activity_heatmap(summary: DataFrame, lookback: str = "4 hours", as_of=None) -> DataFrame:
    rows = _since(summary, "window_start", lookback, as_of).orderBy("symbol", F.desc("window_start"))
    return rows.select(
        "symbol", F.date_format("window_start", MINUTE).alias("time_slot"), "activity_level", "update_count"
    )


def average_spreads(summary: DataFrame, lookback: str = "1 hour", as_of=None) -> DataFrame:
    return (
        _since(summary, "window_start", lookback, as_of)
        .groupBy("symbol")
        .agg(
            F.count("*").alias("windows"),
            _r(F.avg("avg_spread"), 4).alias("avg_spread"),
            _r(F.avg("avg_spread_pct"), 4).alias("avg_spread_pct"),
            _r(F.max("max_spread"), 4).alias("max_spread_seen"),
        )
        .orderBy(F.desc("avg_spread_pct"), "symbol")
    )


def price_vs_average(latest: DataFrame, summary: DataFrame, lookback: str = "15 minutes", as_of=None) -> DataFrame:
    """Latest price against the average of the newest window of its symbol."""
    newest = (
        _since(summary, "window_start", lookback, as_of)
        .groupBy("symbol")
        .agg(F.max_by("avg_price", "window_start").alias("avg_price"))
    )
    price, average = F.col("latest_price").cast("double"), F.col("avg_price").cast("double")
    return latest.join(newest, "symbol").select(
        "symbol",
        _r("latest_price").alias("current_price"),
        _r("avg_price").alias("window_avg"),
        _r((price - average) / average * 100).alias("diff_pct"),
    )


def daily_statistics(latest: DataFrame) -> DataFrame:
    return latest.agg(
        F.count_distinct("symbol").alias("active_symbols"),
        F.sum("updates_24h").alias("total_updates_24h"),
        _r(F.avg("price_change_pct_24h")).alias("avg_change_pct"),
        _r(F.sum("volume_24h")).alias("total_volume_24h"),
    )


def stale_symbols(latest: DataFrame, lookback: str = "5 minutes", as_of=None) -> DataFrame:
    now = as_of_column(as_of)
    stale = latest.filter(F.col("last_updated") < plus(now, lookback, -1)).orderBy("last_updated", "symbol")
    return stale.select(
        "symbol",
        F.date_format("last_updated", SECOND).alias("last_update"),
        (seconds_between(now, F.col("last_updated")) / 60).alias("minutes_since_update"),
    )


def window_completeness(summary: DataFrame, lookback: str = "1 hour", as_of=None) -> DataFrame:
    """A window holds one row per symbol, so counting rows counts symbols."""
    per_window = _since(summary, "window_start", lookback, as_of).groupBy("window_start").agg(
        F.count("symbol").alias("symbols_count"), F.sum("update_count").alias("total_updates")
    )
    return per_window.orderBy(F.desc("window_start")).select(
        F.date_format("window_start", MINUTE).alias("window"), "symbols_count", "total_updates"
    )


def irregular_symbols(summary: DataFrame, lookback: str = "2 hours", as_of=None, expected: int = 8) -> DataFrame:
    return (
        _since(summary, "window_start", lookback, as_of)
        .groupBy("symbol")
        .agg(
            F.count("*").alias("windows_with_data"),
            _r(F.avg("update_count")).alias("avg_updates_per_window"),
            F.min("update_count").alias("min_updates"),
            F.max("update_count").alias("max_updates"),
        )
        .filter(F.col("windows_with_data") < expected)
        .orderBy("windows_with_data", "symbol")
    )


def model_refresh(models: dict[str, tuple[DataFrame, str]], as_of=None) -> DataFrame:
    """Newest refresh time per model and its age; `models` maps a name to (table, column)."""
    now, parts = as_of_column(as_of), []
    for name, (table, column) in models.items():
        newest = table.agg(F.max(column).alias("last_refresh"))
        age = (seconds_between(now, F.col("last_refresh")) / 60).alias("minutes_since_refresh")
        parts.append(newest.select(F.lit(name).alias("model"), "last_refresh", age))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def row_counts(models: dict[str, DataFrame]) -> DataFrame:
    parts = [t.agg(F.count("*").alias("row_count")).select(F.lit(n).alias("model"), "row_count")
             for n, t in models.items()]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result.orderBy("model")


def recent_candles(candles: DataFrame, n: int = 10) -> DataFrame:
    """Newest candles of `candles_by`."""
    return candles.orderBy(F.desc("bucket"), "symbol", "exchange").limit(n)


def summary_statistics(summary: DataFrame) -> DataFrame:
    return summary.agg(
        F.count_distinct("symbol").alias("unique_symbols"),
        F.count("*").alias("total_windows"),
        F.date_format(F.max("window_start"), MINUTE).alias("latest_window"),
    )


def recent_windows(summary: DataFrame, lookback: str = "1 hour", as_of=None, n: int = 5) -> DataFrame:
    newest = _since(summary, "window_start", lookback, as_of).orderBy(F.desc("window_start"), "symbol").limit(n)
    return newest.select(
        "symbol",
        F.date_format("window_start", SLOT).alias("time"),
        _r("avg_price").alias("avg_price"),
        "update_count",
        "activity_level",
    )


def incremental_check(summary: DataFrame, as_of=None) -> DataFrame:
    today = F.date_trunc("day", as_of_column(as_of))
    return summary.filter(F.col("window_start") >= today).agg(
        F.max("window_start").alias("newest_window"), F.count("*").alias("windows")
    )


def windows_by_symbol(summary: DataFrame, lookback: str = "2 hours", as_of=None) -> DataFrame:
    return _since(summary, "window_start", lookback, as_of).groupBy("symbol").agg(F.count("*").alias("windows"))


def raw_summary(ticks: DataFrame) -> DataFrame:
    return ticks.agg(F.count("*").alias("row_count"), F.max("time").alias("last_time"))


def check_prices(ticks: DataFrame) -> DataFrame:
    return (
        ticks.groupBy("symbol")
        .agg(
            F.max("time").alias("latest"),
            F.count("*").alias("total"),
            _r(F.avg("price")).alias("avg_price"),
        )
        .orderBy("symbol")
    )
