"""Monitoring, validation and report jobs. Look-backs span the whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from candlewick.adapters import AS_OF, SPAN, messages, table, ticks
from candlewick.functions.times import bucket_start
from candlewick.plans import monitor
from candlewick.queries.base import NOW, query, sql
from candlewick.queries.models import log_rows, stg_candles
from candlewick.sources import messages as wire
from candlewick.sources.scratch import materialise

_SINCE = f"> {NOW} - INTERVAL 31 DAYS"
_BYTES = """strlen(concat_ws('|', strftime(time, '%Y-%m-%d %H:%M:%S'), symbol, CAST(price AS VARCHAR),
            CAST(volume AS VARCHAR), CAST(bid AS VARCHAR), CAST(ask AS VARCHAR), exchange,
            strftime(inserted_at, '%Y-%m-%d %H:%M:%S')))"""
_LAG_SQL = """SELECT topic, partition, max("offset") + 1 AS high_water,
                     CASE WHEN partition < 4 THEN max("offset") // 2 ELSE 0 END AS next_offset,
                     max("offset") + 1 - CASE WHEN partition < 4 THEN max("offset") // 2 ELSE 0 END AS lag
              FROM messages GROUP BY topic, partition"""


def _committed(spark, sf_dir):
    """Half of each partition is read, nothing of the last two."""
    return (
        messages(spark, sf_dir).filter("partition < 4").groupBy("topic", "partition")
        .agg(F.expr("max(offset) div 2").alias("next_offset"))
    )


def _lag(spark, sf_dir):
    return monitor.consumer_lag(messages(spark, sf_dir), _committed(spark, sf_dir))


@query(
    "recent_activity",
    sql(
        f"""SELECT count(*) AS recent_messages, count(DISTINCT symbol) AS unique_symbols, max(time) AS latest_tick,
                   CASE WHEN count(*) = 0 THEN 'error' ELSE 'ok' END AS status FROM ticks WHERE time {_SINCE}""",
        "ticks",
    ),
)
def recent_activity(spark, sf_dir):
    return monitor.recent_activity(ticks(spark, sf_dir), SPAN, AS_OF)


@query(
    "null_anomalies",
    sql(f"SELECT symbol, count(*) AS null_count FROM ticks WHERE volume < 5 AND time {_SINCE} GROUP BY 1", "ticks"),
)
def null_anomalies(spark, sf_dir):
    """The table has no NULLs, so small volumes are blanked first."""
    source = ticks(spark, sf_dir).withColumn("volume", F.when(F.col("volume") >= 5, F.col("volume")))
    return monitor.null_anomalies(source, SPAN, AS_OF)


@query(
    "ingest_lag",
    sql(
        f"""SELECT (epoch_us({NOW}) - epoch_us(max(time))) / 1000000.0 AS tick_lag_seconds,
                   (epoch_us({NOW}) - epoch_us(max(inserted_at))) / 1000000.0 AS insert_lag_seconds FROM ticks""",
        "ticks",
        "tick_lag_seconds insert_lag_seconds",
    ),
)
def ingest_lag(spark, sf_dir):
    return monitor.ingest_lag(ticks(spark, sf_dir), AS_OF)


@query(
    "data_gaps",
    sql(
        """SELECT symbol, previous AS gap_start, time AS gap_end, (epoch_us(time) - epoch_us(previous)) / 1000000.0 AS gap_seconds
           FROM (SELECT symbol, time, lag(time) OVER (PARTITION BY symbol ORDER BY time) AS previous FROM ticks)
           WHERE (epoch_us(time) - epoch_us(previous)) / 1000000.0 > 600""",
        "ticks",
        "gap_seconds",
    ),
)
def data_gaps(spark, sf_dir):
    return monitor.data_gaps(ticks(spark, sf_dir), 600)


@query(
    "threshold_flags",
    sql(
        f"""SELECT (epoch_us({NOW}) - epoch_us(max(time))) / 1000000.0 > 60 AS high_lag, count(*) < 10 AS low_throughput,
                   (SELECT sum(lag) FROM ({_LAG_SQL})) > 10000 AS high_broker_lag FROM ticks""",
        "ticks messages",
    ),
)
def threshold_flags(spark, sf_dir):
    return monitor.threshold_flags(ticks(spark, sf_dir), _lag(spark, sf_dir), SPAN, AS_OF)


@query("raw_exists", "SELECT count(*) > 0 AS raw_exists FROM events")
def raw_exists(spark, sf_dir):
    return monitor.raw_exists(ticks(spark, sf_dir))


@query(
    "table_stats",
    sql(
        f"""SELECT count(*) AS total_records, max(inserted_at) AS last_insert, count(DISTINCT symbol) AS unique_symbols
            FROM ticks WHERE inserted_at {_SINCE} AND inserted_at <= {NOW}""",
        "ticks",
    ),
)
def table_stats(spark, sf_dir):
    return monitor.table_stats(ticks(spark, sf_dir), SPAN, AS_OF)


WRITE_THROUGHPUT = f"""SELECT date_trunc('minute', inserted_at) AS minute, count(*) AS records, count(DISTINCT symbol) AS symbols,
           round(count(*) / 60, 2) AS records_per_second, round(sum({_BYTES}) / count(*), 2) AS avg_row_bytes,
           round(sum({_BYTES})::DOUBLE / 1024 / 1024, 4) AS mb_written,
           round(sum({_BYTES})::DOUBLE / 1024 / 1024 / 60, 6) AS mb_per_second
    FROM log WHERE inserted_at {_SINCE} AND inserted_at <= {NOW} GROUP BY 1"""


@query("write_throughput", sql(WRITE_THROUGHPUT, "log"))
def write_throughput(spark, sf_dir):
    return monitor.write_throughput(log_rows(spark, sf_dir), SPAN, AS_OF)


@query(
    "write_throughput_function",
    sql(
        f"""SELECT date_trunc('minute', inserted_at) AS time_window, count(*) AS records_written,
                   round(count(*) / 60, 2) AS records_per_second, round(sum({_BYTES}) / 1048576, 4) AS mb_written,
                   round(sum({_BYTES}) / 1048576 / 60, 6) AS mb_per_second
            FROM log WHERE inserted_at {_SINCE} AND inserted_at <= {NOW} GROUP BY 1""",
        "log",
    ),
)
def write_throughput_function(spark, sf_dir):
    """The same as a SQL table function."""
    log_rows(spark, sf_dir).createOrReplaceTempView("cw_tick_log")
    monitor.register_write_throughput(spark, "cw_tick_log")
    return spark.sql("SELECT * FROM get_write_throughput(31 * 24 * 60, TIMESTAMP '2024-01-31 00:00:00')")


@query(
    "throughput_delta",
    sql(
        """SELECT sampled_at, records, greatest(0, records - coalesce(lag(records) OVER (ORDER BY sampled_at), 0)) AS delta_records,
                  round(greatest(0, records - coalesce(lag(records) OVER (ORDER BY sampled_at), 0)) / 600.0, 6) AS records_per_second
           FROM (SELECT time_bucket(INTERVAL 10 MINUTES, inserted_at) AS sampled_at, count(*) AS records FROM ticks GROUP BY 1)""",
        "ticks",
        "records_per_second",
    ),
)
def throughput_delta(spark, sf_dir):
    return monitor.throughput_delta(ticks(spark, sf_dir))


@query(
    "message_throughput",
    sql(
        """SELECT topic, interval_start, messages, bytes, messages / 3600.0 AS messages_per_second,
                  bytes / 3600.0 AS bytes_per_second, bytes / 1048576.0 / 3600 AS mb_per_second
           FROM (SELECT topic, date_trunc('hour', timestamp) AS interval_start, count(*) AS messages,
                        CAST(sum(strlen(CASE WHEN broken THEN left(full_value, 20) ELSE full_value END)) AS BIGINT) AS bytes
                 FROM messages GROUP BY ALL)""",
        "messages",
        "messages_per_second bytes_per_second mb_per_second",
    ),
)
def message_throughput(spark, sf_dir):
    return monitor.message_throughput(messages(spark, sf_dir), "1 hour")


@query("consumer_lag", sql(_LAG_SQL, "messages"))
def consumer_lag(spark, sf_dir):
    return _lag(spark, sf_dir)


@query(
    "latency_histogram",
    sql(
        """SELECT le, (SELECT count(*) FROM ticks WHERE (epoch_us(inserted_at) - epoch_us(time)) / 1000000.0 <= le)
                    AS cumulative_count
           FROM (SELECT unnest([0.001, 0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0, 60.0, 120.0, 'inf'::DOUBLE]::DOUBLE[]) AS le)""",
        "ticks",
    ),
)
def latency_histogram(spark, sf_dir):
    """Latencies here reach two minutes, so two wider bounds are added."""
    bounds = (*monitor.LATENCY_BUCKETS, 60.0, 120.0)
    return monitor.latency_histogram(ticks(spark, sf_dir), bounds)


@query(
    "counter_rate",
    sql(
        """WITH c AS (SELECT symbol AS counter, time_bucket(INTERVAL 1 HOURS, time) AS sampled_at, count(*) AS value
                      FROM ticks GROUP BY ALL),
                g AS (SELECT *, CASE WHEN lag(value) OVER w IS NULL THEN 0 WHEN value < lag(value) OVER w THEN value
                             ELSE value - lag(value) OVER w END AS growth FROM c WINDOW w AS (PARTITION BY counter ORDER BY sampled_at))
           SELECT counter, sampled_at, value, sum(growth) OVER (PARTITION BY counter ORDER BY epoch_us(sampled_at)
                    RANGE BETWEEN 21599999999 PRECEDING AND CURRENT ROW) / 21600.0 AS per_second FROM g""",
        "ticks",
        "per_second",
    ),
)
def counter_rate(spark, sf_dir):
    """Hourly tick counts as counter samples: they go up and down, so restarts occur."""
    samples = (
        ticks(spark, sf_dir)
        .groupBy(F.col("symbol").alias("counter"), bucket_start("time", "1 hour").alias("sampled_at"))
        .agg(F.count("*").alias("value"))
    )
    return monitor.counter_rate(samples, window="6 hours", every="1 hour")


@query(
    "success_ratio",
    sql(
        """WITH c AS (SELECT time_bucket(INTERVAL 1 HOURS, timestamp) AS sampled_at, count(*) AS total,
                             count_if(NOT broken) AS good FROM messages GROUP BY 1),
                r AS (SELECT sampled_at, sum(good) OVER w AS good, sum(total) OVER w AS total FROM c
                      WINDOW w AS (ORDER BY sampled_at ROWS UNBOUNDED PRECEDING)),
                d AS (SELECT sampled_at, coalesce(good - lag(good) OVER (ORDER BY sampled_at), 0) AS g,
                             coalesce(total - lag(total) OVER (ORDER BY sampled_at), 0) AS t FROM r),
                q AS (SELECT sampled_at, round(sum(g) OVER w / 21600.0, 6) AS g, round(sum(t) OVER w / 21600.0, 6) AS t
                      FROM d WINDOW w AS (ORDER BY epoch_us(sampled_at) RANGE BETWEEN 21599999999 PRECEDING AND CURRENT ROW))
           SELECT sampled_at, g / nullif(t, 0) AS ratio FROM q""",
        "messages",
        "ratio",
    ),
)
def success_ratio(spark, sf_dir):
    """Accepted against received messages, from running totals sampled every hour."""
    parsed = wire.parse_messages(messages(spark, sf_dir))
    hourly = parsed.groupBy(bucket_start("timestamp", "1 hour").alias("sampled_at")).agg(
        F.count("*").alias("total"), F.count_if(F.col("problem").isNull()).alias("good")
    )
    return monitor.success_ratio(monitor.counter_rate(monitor.running_totals(hourly, ["good", "total"]),
                                                      window="6 hours"), "good", "total")


@query(
    "throughput_report",
    sql(
        f"""SELECT m.messages, CAST(m.message_bytes AS BIGINT) AS message_bytes, CAST(m.errors AS BIGINT) AS errors,
                   CAST(g.lag_messages AS BIGINT) AS lag_messages, l.records, CAST(l.record_bytes AS BIGINT) AS record_bytes,
                   m.messages / m.s AS messages_per_second, m.message_bytes / 1048576.0 / m.s AS message_mb_per_second,
                   l.records / l.s AS records_per_second, l.record_bytes / 1048576.0 / l.s AS record_mb_per_second
            FROM (SELECT count(*) AS messages, sum(strlen(CASE WHEN broken THEN left(full_value, 20) ELSE full_value END)) AS message_bytes,
                         count_if(broken) AS errors, (epoch_us(max(timestamp)) - epoch_us(min(timestamp))) / 1000000.0 AS s FROM messages) m,
                 (SELECT count(*) AS records, sum({_BYTES}) AS record_bytes,
                         (epoch_us(max(inserted_at)) - epoch_us(min(inserted_at))) / 1000000.0 AS s FROM log) l,
                 (SELECT sum(lag) AS lag_messages FROM ({_LAG_SQL})) g""",
        "messages log",
        "messages_per_second message_mb_per_second records_per_second record_mb_per_second",
    ),
)
def throughput_report(spark, sf_dir):
    source = messages(spark, sf_dir)
    rejects = wire.rejected(wire.parse_messages(source))
    return monitor.throughput_report(log_rows(spark, sf_dir), source, rejects, _lag(spark, sf_dir))


@query(
    "state_counts",
    """SELECT count(*) AS total, CAST(count_if(o_orderstatus = 'F') AS BIGINT) AS F,
              CAST(count_if(o_orderstatus = 'O') AS BIGINT) AS O, CAST(count_if(o_orderstatus = 'P') AS BIGINT) AS P
       FROM orders""",
)
def state_counts(spark, sf_dir):
    return monitor.state_counts(table(spark, sf_dir, "orders"), "o_orderstatus", ["F", "O", "P"])


@query(
    "ohlcv_coverage",
    sql(
        f"""SELECT count(*) AS period_count, count(DISTINCT symbol) AS symbol_count, min(period_start) AS earliest,
                   max(period_start) AS latest FROM candles WHERE period_start {_SINCE}""",
        "candles",
    ),
)
def ohlcv_coverage(spark, sf_dir):
    return monitor.ohlcv_coverage(stg_candles(spark, sf_dir), SPAN, AS_OF)


@query(
    "ohlcv_anomalies",
    sql(
        f"""SELECT symbol, count(*) AS anomaly_count FROM candles
            WHERE period_start {_SINCE} AND (high < low OR close < 0 OR total_volume - 20 < 0) GROUP BY 1""",
        "candles",
    ),
)
def ohlcv_anomalies(spark, sf_dir):
    """Volumes lowered by 20, so that some candles are anomalous."""
    shifted = stg_candles(spark, sf_dir).withColumn("total_volume", F.col("total_volume") - 20)
    return monitor.ohlcv_anomalies(shifted, SPAN, AS_OF)


_MISSING_SQL = f"""SELECT period_start FROM (SELECT unnest(generate_series({NOW} - INTERVAL 31 DAYS, {NOW},
                     INTERVAL 15 MINUTES)) AS period_start)
                   WHERE period_start NOT IN (SELECT period_start FROM candles)"""


@query("missing_periods", sql(_MISSING_SQL, "candles"))
def missing_periods(spark, sf_dir):
    return monitor.missing_periods(stg_candles(spark, sf_dir), SPAN, AS_OF)


@query(
    "validation_summary",
    sql(
        f"""SELECT validation, found, CASE WHEN (validation = 'candles_exist') = (found > 0) THEN 'passed' ELSE 'failed' END AS outcome
            FROM (SELECT 'candles_exist' AS validation, count(*) AS found FROM candles WHERE period_start {_SINCE}
                  UNION ALL SELECT 'no_anomalies', count(*) FROM candles
                    WHERE period_start {_SINCE} AND (high < low OR close < 0 OR total_volume < 0)
                  UNION ALL SELECT 'no_missing_periods', count(*) FROM ({_MISSING_SQL}))""",
        "candles",
    ),
)
def validation_summary(spark, sf_dir):
    return monitor.validation_summary(materialise(stg_candles(spark, sf_dir), "model"), SPAN, AS_OF)


@query(
    "quality_report",
    sql(
        f"""SELECT symbol, count(*) AS data_points, CAST(avg(close) AS DECIMAL(38,12)) AS avg_price,
                   stddev_samp(CAST(close AS DOUBLE)) AS price_stddev, min(close) AS min_price, max(close) AS max_price,
                   sum(total_volume) AS total_volume FROM candles WHERE period_start {_SINCE} GROUP BY 1""",
        "candles",
        "avg_price price_stddev min_price max_price total_volume",
    ),
)
def quality_report(spark, sf_dir):
    return monitor.quality_report(stg_candles(spark, sf_dir), SPAN, AS_OF)
