"""Staging, candles, latest prices, summaries, their incremental forms, alerts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.adapters import AS_OF, ticks
from candlewick.plans import alerts, candles, latest, refresh, summary
from candlewick.plans.staging import staged_ticks
from candlewick.queries.base import (
    CANDLE_NUMBERS,
    CANDLE_X_NUMBERS,
    LATEST_NUMBERS,
    NOW,
    SUMMARY_NUMBERS,
    query,
    sql,
)
from candlewick.sources.log import DAY, to_log_rows, write_table
from candlewick.sources.scratch import new_folder

HALFWAY = "2024-01-15 00:00:00"


def stg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staged_ticks(ticks(spark, sf_dir))


def stg_candles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return candles.candles(stg(spark, sf_dir))


def stg_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest.latest_prices(stg(spark, sf_dir), AS_OF)


def stg_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.price_summary(stg(spark, sf_dir), AS_OF)


def log_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_log_rows(ticks(spark, sf_dir))


query("stg_ticks", sql("SELECT * FROM stg", "stg", "price volume bid ask spread spread_pct"))(stg)
query("ohlcv_15min", sql("SELECT * FROM candles", "candles", CANDLE_NUMBERS))(stg_candles)
query("latest_prices", sql("SELECT * FROM latest", "latest", LATEST_NUMBERS))(stg_latest)
query("price_summary", sql("SELECT * FROM summary", "summary", SUMMARY_NUMBERS))(stg_summary)


@query("latest_prices_table", sql("SELECT * FROM latest", "latest", LATEST_NUMBERS))
def latest_prices_table(spark, sf_dir):
    """Built in full twice, as a table is on every run; the second build replaces the first."""
    path = new_folder(spark, "latest")
    for _ in range(2):
        write_table(stg_latest(spark, sf_dir), path)
    return spark.read.parquet(path)


@query("ohlcv_windowed", sql("SELECT * FROM candles", "candles", CANDLE_NUMBERS))
def ohlcv_windowed(spark, sf_dir):
    return candles.candles_windowed(stg(spark, sf_dir))


@query("ohlcv_by_exchange", sql("SELECT * FROM candles_x", "candles_x", CANDLE_X_NUMBERS))
def ohlcv_by_exchange(spark, sf_dir):
    return candles.candles_by(log_rows(spark, sf_dir))


@query(
    "stats_24h",
    sql(
        "SELECT symbol, min_price_24h, max_price_24h, avg_price_24h, volume_24h, updates_24h FROM latest",
        "latest",
        "min_price_24h max_price_24h avg_price_24h volume_24h",
    ),
)
def stats_24h(spark, sf_dir):
    return latest.stats_24h(stg(spark, sf_dir), AS_OF)


@query(
    "nearest_price",
    sql(
        f"""SELECT symbol, price AS price_24h_ago, time AS price_time FROM stg
            WHERE time BETWEEN {NOW} - INTERVAL 25 HOURS AND {NOW} - INTERVAL 23 HOURS
            QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY
              abs(epoch_us(time) - epoch_us({NOW} - INTERVAL 24 HOURS)), time, id) = 1""",
        "stg",
        "price_24h_ago",
    ),
)
def nearest_price(spark, sf_dir):
    return latest.nearest_price(stg(spark, sf_dir), AS_OF)


@query(
    "asof_price",
    sql(
        """SELECT t.id, t.time, t.symbol, t.price, e.price AS earlier_price, e.time AS earlier_time,
                  CASE WHEN e.price > 0 THEN t.price - e.price END AS change,
                  CASE WHEN e.price > 0 THEN CAST(t.price - e.price AS DOUBLE) / CAST(e.price AS DOUBLE) * 100 END AS change_pct
           FROM stg t LEFT JOIN stg e ON t.symbol = e.symbol
             AND e.time BETWEEN t.time - INTERVAL 25 HOURS AND t.time - INTERVAL 23 HOURS
           QUALIFY row_number() OVER (PARTITION BY t.id ORDER BY
             abs(epoch_us(e.time) - epoch_us(t.time - INTERVAL 24 HOURS)) NULLS LAST, e.time, e.id) = 1""",
        "stg",
        "price earlier_price change change_pct",
    ),
)
def asof_price(spark, sf_dir):
    """The price a day ago of every tick."""
    return latest.earlier_prices(stg(spark, sf_dir))


@query("incremental_ohlcv", sql("SELECT * FROM candles", "candles", CANDLE_NUMBERS))
def incremental_ohlcv(spark, sf_dir):
    """First half as a full load, the rest as an increment with its lookback."""
    path, source = new_folder(spark, "ohlcv"), stg(spark, sf_dir)
    refresh.refresh_candles(source.filter(F.col("time") < HALFWAY), path)
    refresh.refresh_candles(source, path)
    return spark.read.parquet(path).drop(DAY)


@query("incremental_summary", sql("SELECT * FROM summary", "summary", SUMMARY_NUMBERS))
def incremental_summary(spark, sf_dir):
    path, source = new_folder(spark, "summary"), stg(spark, sf_dir)
    refresh.refresh_summary(source.filter(F.col("time") < HALFWAY), path, AS_OF, full_refresh=True)
    refresh.refresh_summary(source, path, AS_OF)
    return spark.read.parquet(path).drop(DAY)


@query(
    "cagg_refresh",
    sql(f"SELECT * FROM candles_x WHERE bucket < {NOW} - INTERVAL 15 MINUTES", "candles_x", CANDLE_X_NUMBERS),
)
def cagg_refresh(spark, sf_dir):
    """Two policy runs with overlapping ranges; the bucket still open at the end offset is left out."""
    path, source = new_folder(spark, "cagg"), log_rows(spark, sf_dir)
    refresh.refresh_range(source, path, HALFWAY, start_offset="31 days")
    refresh.refresh_range(source, path, AS_OF, start_offset="18 days")
    return spark.read.parquet(path).drop(DAY)


@query("cagg_realtime", sql("SELECT * FROM candles_x", "candles_x", CANDLE_X_NUMBERS))
def cagg_realtime(spark, sf_dir):
    path, source = new_folder(spark, "cagg"), log_rows(spark, sf_dir)
    refresh.refresh_range(source, path, HALFWAY, start_offset="31 days")
    return refresh.realtime_candles(source, path)


ALERTS = """SELECT symbol, time, id, old_price, price AS new_price,
          (CAST(price AS DOUBLE) - CAST(old_price AS DOUBLE)) / CAST(old_price AS DOUBLE) * 100 AS price_change_pct,
          printf('ALERT: %s price changed by %.2f%% in last 5 minutes (%s -> %s)', symbol,
            (CAST(price AS DOUBLE) - CAST(old_price AS DOUBLE)) / CAST(old_price AS DOUBLE) * 100,
            CAST(old_price AS VARCHAR), CAST(price AS VARCHAR)) AS message
   FROM (SELECT *, first_value(price) OVER (PARTITION BY symbol ORDER BY time
                     RANGE BETWEEN INTERVAL 5 MINUTES PRECEDING AND CURRENT ROW) AS old_price FROM stg)
   WHERE abs((CAST(price AS DOUBLE) - CAST(old_price AS DOUBLE)) / CAST(old_price AS DOUBLE) * 100) > 10"""
ALERT_NUMBERS = "old_price new_price price_change_pct"


@query("price_alerts", sql(ALERTS, "stg", ALERT_NUMBERS))
def price_alerts(spark, sf_dir):
    return alerts.price_alerts(stg(spark, sf_dir))
