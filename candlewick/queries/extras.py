"""Extensions over the models."""

from __future__ import annotations

from pyspark.sql import functions as F

from candlewick.adapters import AS_OF, ticks
from candlewick.plans import alerts, candles, extras
from candlewick.queries.base import CANDLE_NUMBERS, query, sql
from candlewick.queries.models import log_rows, stg, stg_candles
from candlewick.sources import log
from candlewick.sources.scratch import new_folder


@query(
    "ext_vwap",
    sql(
        """SELECT symbol, time_bucket(INTERVAL 15 MINUTES, time) AS window_start,
                  sum(CAST(price AS DOUBLE) * CAST(volume AS DOUBLE)) / nullif(sum(CAST(volume AS DOUBLE)), 0) AS vwap,
                  sum(CAST(volume AS DOUBLE)) AS total_volume FROM stg GROUP BY ALL""",
        "stg",
        ratios="vwap total_volume",
    ),
)
def ext_vwap(spark, sf_dir):
    return extras.vwap(stg(spark, sf_dir))


@query(
    "ext_momentum",
    sql(
        """SELECT symbol, period_start, close, close - before AS momentum,
                  CASE WHEN before > 0 THEN CAST(close - before AS DOUBLE) / CAST(before AS DOUBLE) * 100 END AS momentum_pct
           FROM (SELECT *, lag(close, 4) OVER (PARTITION BY symbol ORDER BY period_start) AS before FROM candles)""",
        "candles",
        "close momentum momentum_pct",
    ),
)
def ext_momentum(spark, sf_dir):
    return extras.momentum(stg_candles(spark, sf_dir))


@query(
    "ext_rsi",
    sql(
        """SELECT symbol, period_start, CASE WHEN known = 14 THEN gain / nullif(gain + loss, 0) * 100 END AS rsi FROM (
             SELECT symbol, period_start, count(step) OVER w AS known,
                    CAST(sum(CASE WHEN step > 0 THEN step ELSE 0 END) OVER w AS DOUBLE) AS gain,
                    CAST(sum(CASE WHEN step < 0 THEN -step ELSE 0 END) OVER w AS DOUBLE) AS loss
             FROM (SELECT symbol, period_start, close - lag(close) OVER (PARTITION BY symbol ORDER BY period_start) AS step
                   FROM candles)
             WINDOW w AS (PARTITION BY symbol ORDER BY period_start ROWS BETWEEN 13 PRECEDING AND CURRENT ROW))""",
        "candles",
        "rsi",
    ),
)
def ext_rsi(spark, sf_dir):
    return extras.rsi(stg_candles(spark, sf_dir))


def _rollup_sql(width: str) -> str:
    return f"""SELECT '{width.lower()}' AS width, time_bucket(INTERVAL {width}, period_start) AS period_start, symbol,
                      first(open ORDER BY period_start) AS open, max(high) AS high, min(low) AS low,
                      last(close ORDER BY period_start) AS close, sum(total_volume) AS total_volume,
                      CAST(sum(trade_count) AS BIGINT) AS trade_count FROM candles GROUP BY ALL"""


@query(
    "ext_ohlcv_rollup",
    sql(f"{_rollup_sql('1 HOUR')} UNION ALL {_rollup_sql('1 DAY')}", "candles", CANDLE_NUMBERS),
)
def ext_ohlcv_rollup(spark, sf_dir):
    hourly = candles.rollup(stg_candles(spark, sf_dir), "1 hour")
    daily = candles.rollup(hourly, "1 day")
    return hourly.withColumn("width", F.lit("1 hour")).unionByName(daily.withColumn("width", F.lit("1 day")))


LEVELS = (0.5, 1.0, 2.0, 3.0, 5.0, 10.0)


@query(
    "ext_alert_levels",
    sql(
        """SELECT symbol, level, count(*) AS alerts, max(moved) AS largest_move_pct FROM (
             SELECT symbol, abs((CAST(price AS DOUBLE) - CAST(old AS DOUBLE)) / CAST(old AS DOUBLE) * 100) AS moved,
                    unnest([0.5, 1, 2, 3, 5, 10]::DOUBLE[]) AS level
             FROM (SELECT *, first_value(price) OVER (PARTITION BY symbol ORDER BY time
                               RANGE BETWEEN INTERVAL 5 MINUTES PRECEDING AND CURRENT ROW) AS old FROM stg))
           WHERE moved > level GROUP BY ALL""",
        "stg",
        "level largest_move_pct",
    ),
)
def ext_alert_levels(spark, sf_dir):
    return alerts.alert_levels(stg(spark, sf_dir), LEVELS)


@query(
    "ext_clean_ticks",
    sql("SELECT * REPLACE (upper(symbol) AS symbol) FROM ticks WHERE volume >= 0", "ticks", "price volume bid ask"),
)
def ext_clean_ticks(spark, sf_dir):
    """Every tick twice, the copy with a later id and a badly written symbol."""
    source = ticks(spark, sf_dir)
    copies = source.withColumns(
        {"id": F.col("id") + 1_000_000_000_000, "symbol": F.concat(F.lit(" "), F.initcap("symbol"))}
    )
    return extras.clean_ticks(source.unionByName(copies))


@query(
    "ext_quality_kpis",
    sql(
        """SELECT count(*) AS ticks, 100.0 * count_if(price IS NULL OR volume IS NULL) / count(*) AS incomplete_pct,
                  100.0 * (count(*) - count(DISTINCT (symbol, time))) / count(*) AS repeated_pct,
                  100.0 * count_if(price <= 0 OR volume < 0) / count(*) AS impossible_pct,
                  100.0 * (SELECT count(*) FROM (SELECT time - lag(time) OVER (PARTITION BY symbol ORDER BY time) AS gap
                             FROM ticks) WHERE gap > INTERVAL 600 SECONDS) / count(*) AS gaps_pct FROM ticks""",
        "ticks",
        "incomplete_pct repeated_pct impossible_pct gaps_pct",
    ),
)
def ext_quality_kpis(spark, sf_dir):
    return extras.quality_kpis(ticks(spark, sf_dir), 600)


@query(
    "ext_downsample_expire",
    sql(
        """SELECT 'candles' AS kept, symbol, CAST(time AS DATE) AS dt, count(*) AS ticks, sum(volume) AS volume FROM log
           WHERE time < TIMESTAMP '2024-01-11 00:00:00' GROUP BY ALL
           UNION ALL SELECT 'log', symbol, CAST(time AS DATE), count(*), sum(volume) FROM log
           WHERE time >= TIMESTAMP '2024-01-11 00:00:00' GROUP BY ALL""",
        "log",
        "volume",
    ),
)
def ext_downsample_expire(spark, sf_dir):
    """Old days live on as hourly candles, recent ones as ticks; together they cover everything."""
    log_path, summary_path = new_folder(spark, "log"), new_folder(spark, "hourly")
    log.append_log(log_rows(spark, sf_dir), log_path)
    extras.downsample_then_expire(spark, log_path, summary_path, AS_OF, keep_days=20)
    stored = extras.downsampled(spark, summary_path).groupBy(F.lit("candles").alias("kept"), "symbol", "dt")
    live = log.read_log(spark, log_path).groupBy(F.lit("log").alias("kept"), "symbol", "dt")
    return stored.agg(F.sum("trade_count").alias("ticks"), F.sum("total_volume").alias("volume")).unionByName(
        live.agg(F.count("*").alias("ticks"), F.sum("volume").alias("volume"))
    )
