"""Registry and the shared parts of the comparison SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.session import setting

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

NOW = "TIMESTAMP '2024-01-31 00:00:00'"


EXACT, ROUNDED = 8, 6  # digits of decimals, and of ratios and deviations


def comparable(df: DataFrame) -> DataFrame:
    """Numbers as doubles, the form both engines agree on: decimals with all eight digits that prices and volumes have
    (averages of them too), ratios and deviations with six; infinity and NaN stay.

    The way over a decimal makes ties round alike, whatever the last bit of a double is.
    """

    def shown(field: T.StructField):
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            return F.round(column.cast("decimal(38,12)"), EXACT).cast("double").alias(field.name)
        if isinstance(field.dataType, T.FractionalType):
            odd = (F.abs(column) == float("inf")) | F.isnan(column)
            rounded = F.round(F.when(~odd, column).cast("decimal(38,12)"), ROUNDED).cast("double")
            return F.when(odd, column.cast("double")).otherwise(rounded).alias(field.name)
        return column

    return df.select([shown(f) for f in df.schema])


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(build: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            with setting(spark, spark__sql__session__timeZone="UTC"):
                return comparable(build(spark, sf_dir))

        run.build = build  # without the rounding for comparison
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return build

    return add


_PCT = "CASE WHEN {b} > 0 THEN CAST({a} - {b} AS DOUBLE) / CAST({b} AS DOUBLE) * 100 END"

# Named parts, in dependency order.
PARTS = {
    "ticks": """
        SELECT event_id AS id, ts AS time, event_type AS symbol, CAST(value AS DECIMAL(20,8)) AS price,
               CAST(json_extract_string(props, '$.k') AS DECIMAL(30,8)) AS volume,
               CAST(CAST(value AS DECIMAL(20,8)) * 0.999 AS DECIMAL(20,8)) AS bid,
               CAST(CAST(value AS DECIMAL(20,8)) * 1.001 AS DECIMAL(20,8)) AS ask,
               CASE WHEN event_id % 3 <> 0 THEN 'ex' || (event_id % 3) END AS exchange,
               ts + to_seconds(event_id % 120) AS inserted_at
        FROM events""",
    "log": "SELECT * REPLACE (coalesce(exchange, 'coinbase') AS exchange) FROM ticks",
    "messages": """
        SELECT symbol || '_' || strftime(time, '%Y-%m-%dT%H:%M:%S.%f') AS key, id % 50 = 0 AS broken,
               CASE WHEN id % 2 = 0 THEN 'ticks' ELSE 'ticks_alt' END AS topic, CAST(id % 6 AS INTEGER) AS partition,
               id // 6 AS "offset", time AS timestamp,
               '{"symbol":"' || symbol || '","price":' || CAST(CAST(price AS DOUBLE) AS VARCHAR)
               || ',"volume":' || CAST(CAST(volume AS BIGINT) AS VARCHAR)
               || ',"bid":' || CAST(CAST(bid AS DOUBLE) AS VARCHAR) || ',"ask":' || CAST(CAST(ask AS DOUBLE) AS VARCHAR)
               || ',"currency":"USD","timestamp":"' || strftime(time, '%Y-%m-%dT%H:%M:%S.%f')
               || '","source":"' || exchange || '"}' AS full_value, *
        FROM log""",
    # ticks as ingest makes them from whole messages: the id is the place in the message log
    "ingested": """
        SELECT "offset" * 1048576 + ('0x' || substr(md5(topic || '/' || partition), 1, 5))::BIGINT AS id, time, symbol, price,
               volume, bid, ask, exchange, timestamp AS inserted_at
        FROM messages WHERE NOT broken""",
    "stg": """
        SELECT id, time, symbol, price, volume, bid, ask, exchange, inserted_at,
               CASE WHEN bid > 0 AND ask > 0 THEN ask - bid END AS spread,
               CASE WHEN bid > 0 AND ask > 0 THEN CAST(ask - bid AS DOUBLE) / CAST(ask AS DOUBLE) * 100 END AS spread_pct
        FROM log WHERE price > 0 AND symbol IS NOT NULL AND time IS NOT NULL""",
    "candles": """
        SELECT md5(strftime(time_bucket(INTERVAL 15 MINUTES, time), '%Y-%m-%d %H:%M:%S') || '|' || symbol) AS period_key,
               time_bucket(INTERVAL 15 MINUTES, time) AS period_start, symbol,
               first(price ORDER BY time, id) AS open, max(price) AS high, min(price) AS low,
               last(price ORDER BY time, id) AS close, sum(volume) AS total_volume, count(*) AS trade_count
        FROM stg GROUP BY ALL""",
    "candles_x": """
        SELECT time_bucket(INTERVAL 15 MINUTES, time) AS bucket, symbol, exchange,
               first(price ORDER BY time, id) AS open, max(price) AS high, min(price) AS low,
               last(price ORDER BY time, id) AS close, sum(volume) AS volume, count(*) AS num_trades,
               CAST(avg(price) AS DECIMAL(38,12)) AS avg_price, stddev_samp(CAST(price AS DOUBLE)) AS price_stddev
        FROM log GROUP BY ALL""",
    "latest": f"""
        SELECT symbol, last.price AS latest_price, last.volume AS latest_volume, last.bid AS latest_bid,
               last.ask AS latest_ask, last.spread AS spread, last.spread_pct AS spread_percentage, price_24h_ago,
               CASE WHEN price_24h_ago > 0 THEN last.price - price_24h_ago END AS price_change_24h,
               {_PCT.format(a="last.price", b="price_24h_ago")} AS price_change_pct_24h,
               min_price_24h, max_price_24h, avg_price_24h, volume_24h, updates_24h, last.exchange AS exchange,
               last.time AS last_updated, last.inserted_at AS last_inserted_at, {NOW} AS refreshed_at
        FROM (SELECT symbol, arg_max(d, [epoch_us(d.time), epoch_us(d.inserted_at), d.id]) FILTER (recent) AS last,
                     arg_min(d.price, [abs(away), away, d.id]) FILTER (abs(away) <= 3600000000) AS price_24h_ago,
                     min(d.price) FILTER (recent) AS min_price_24h, max(d.price) FILTER (recent) AS max_price_24h,
                     CAST(avg(d.price) FILTER (recent) AS DECIMAL(38,12)) AS avg_price_24h,
                     sum(d.volume) FILTER (recent) AS volume_24h, count(*) FILTER (recent) AS updates_24h
              FROM (SELECT symbol, stg AS d, time >= {NOW} - INTERVAL 24 HOURS AND time <= {NOW} AS recent,
                           epoch_us(time) - epoch_us({NOW} - INTERVAL 24 HOURS) AS away FROM stg)
              GROUP BY symbol)
        WHERE updates_24h > 0""",
    "summary": f"""
        SELECT md5(strftime(window_start, '%Y-%m-%d %H:%M:%S') || '|' || symbol) AS window_id, window_start,
               window_start + INTERVAL 15 MINUTES AS window_end, symbol, min_price, max_price, avg_price, price_stddev,
               total_volume, avg_volume, avg_bid, avg_ask, avg_spread, avg_spread_pct, max_spread, update_count,
               unique_seconds_with_updates,
               CASE WHEN update_count > 0 THEN round(unique_seconds_with_updates / update_count * 100, 2) END
                 AS update_distribution_pct,
               max_price - min_price AS price_range,
               {_PCT.format(a="max_price", b="min_price")} AS price_range_percentage,
               CASE WHEN avg_price > 0 THEN price_stddev / CAST(avg_price AS DOUBLE) * 100 END AS coefficient_of_variation,
               first_price, last_price, {_PCT.format(a="last_price", b="first_price")} AS period_return_percentage,
               CASE WHEN update_count >= 100 THEN 'Very High' WHEN update_count >= 50 THEN 'High'
                    WHEN update_count >= 20 THEN 'Medium' WHEN update_count >= 5 THEN 'Low' ELSE 'Very Low' END
                 AS activity_level,
               {NOW} AS updated_at
        FROM (SELECT time_bucket(INTERVAL 15 MINUTES, time) AS window_start, symbol, min(price) AS min_price,
                     max(price) AS max_price, CAST(avg(price) AS DECIMAL(38,12)) AS avg_price,
                     stddev_samp(CAST(price AS DOUBLE)) AS price_stddev, sum(volume) AS total_volume,
                     CAST(avg(volume) AS DECIMAL(38,12)) AS avg_volume, CAST(avg(bid) AS DECIMAL(38,12)) AS avg_bid,
                     CAST(avg(ask) AS DECIMAL(38,12)) AS avg_ask, CAST(avg(spread) AS DECIMAL(38,12)) AS avg_spread,
                     avg(spread_pct) AS avg_spread_pct, max(spread) AS max_spread, count(*) AS update_count,
                     count(DISTINCT date_trunc('second', time)) AS unique_seconds_with_updates,
                     first(price ORDER BY time, id) AS first_price, last(price ORDER BY time, id) AS last_price
              FROM stg GROUP BY ALL)""",
}
_NEEDS = {
    "log": ["ticks"],
    "messages": ["ticks", "log"],
    "ingested": ["ticks", "log", "messages"],
    "stg": ["ticks", "log"],
    "candles": ["ticks", "log", "stg"],
    "candles_x": ["ticks", "log"],
    "latest": ["ticks", "log", "stg"],
    "summary": ["ticks", "log", "stg"],
}


# Columns that are ratios or deviations, doubles in both engines.
RATIOS = set(
    """price_stddev spread_pct spread_percentage price_change_pct_24h avg_spread_pct update_distribution_pct
    price_range_percentage coefficient_of_variation period_return_percentage price_change_pct momentum_pct rsi vwap
    largest_move_pct level per_second ratio incomplete_pct repeated_pct impossible_pct gaps_pct change_pct""".split()
)


def sql(body: str, parts: str = "", numbers: str = "", ratios: str = "") -> str:
    """`body` over the named parts; `numbers` and `ratios` list the columns to round as `comparable` does."""
    wanted = {p for part in parts.split() for p in [part, *_NEEDS.get(part, [])]}
    ctes = ", ".join(f"{name} AS ({PARTS[name]})" for name in PARTS if name in wanted)
    digits = {n: ROUNDED if n in RATIOS else EXACT for n in numbers.split()} | {n: ROUNDED for n in ratios.split()}
    rounded = ", ".join(f"CAST(round(CAST({n} AS DECIMAL(38,12)), {d}) AS DOUBLE) AS {n}" for n, d in digits.items())
    outer = f"SELECT * REPLACE ({rounded}) FROM ({body}) AS result" if rounded else body
    return f"WITH {ctes} {outer}" if ctes else outer


CANDLE_NUMBERS = "open high low close total_volume"
CANDLE_X_NUMBERS = "open high low close volume avg_price price_stddev"
LATEST_NUMBERS = (
    "latest_price latest_volume latest_bid latest_ask spread spread_percentage price_24h_ago price_change_24h "
    "price_change_pct_24h min_price_24h max_price_24h avg_price_24h volume_24h"
)
SUMMARY_NUMBERS = (
    "min_price max_price avg_price price_stddev total_volume avg_volume avg_bid avg_ask avg_spread avg_spread_pct "
    "max_spread update_distribution_pct price_range price_range_percentage coefficient_of_variation first_price "
    "last_price period_return_percentage"
)
