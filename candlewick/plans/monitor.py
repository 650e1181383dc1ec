"""Freshness, lag, gaps, throughput, and validation jobs. Relative filters count back from `as_of`."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.functions.numbers import safe_divide, to_mebibytes
from candlewick.functions.times import as_of_column, bucket_start, micros, plus, seconds_between
from candlewick.operators import ordered
from candlewick.operators.asof import as_of
from candlewick.operators.joins import side_by_side
from candlewick.operators.ordered import in_steps, with_previous
from candlewick.sources.log import on_days

# Histogram bounds in seconds and in rows.
LATENCY_BUCKETS = (0.001, 0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0)
BATCH_SIZE_BUCKETS = (1, 10, 25, 50, 100, 250, 500, 1000)
# Alarm limits.
MAX_LAG_SECONDS, MIN_RECENT_MESSAGES, MAX_BROKER_LAG = 60, 10, 10_000


def recent(df: DataFrame, column: str, lookback: str, as_of=None) -> DataFrame:
    """Rows of the lookback; bounds on a tick's `time` also bound its day."""
    now = as_of_column(as_of)
    first = plus(now, lookback, -1)
    found = df.filter((F.col(column) > first) & (F.col(column) <= now))
    return on_days(found, first, now) if column == "time" else found


# --- freshness -------------------------------------------------------------------------------------------------


def recent_activity(ticks: DataFrame, lookback: str = "10 seconds", as_of=None) -> DataFrame:
    """Messages, symbols and newest tick of the lookback; status 'error' when there are none."""
    row = recent(ticks, "time", lookback, as_of).agg(
        F.count("*").alias("recent_messages"),
        F.count_distinct("symbol").alias("unique_symbols"),
        F.max("time").alias("latest_tick"),
    )
    return row.withColumn("status", F.when(F.col("recent_messages") == 0, "error").otherwise("ok"))


def null_anomalies(ticks: DataFrame, lookback: str = "60 seconds", as_of=None) -> DataFrame:
    """Ticks without price or volume per symbol."""
    incomplete = recent(ticks, "time", lookback, as_of).filter(F.col("price").isNull() | F.col("volume").isNull())
    return incomplete.groupBy("symbol").agg(F.count("*").alias("null_count"))


def ingest_lag(ticks: DataFrame, as_of=None) -> DataFrame:
    """Seconds since the newest tick and since the newest insert; 0 on an empty log."""
    now = as_of_column(as_of)
    newest = ticks.agg(F.max("time").alias("t"), F.max("inserted_at").alias("i"))
    return newest.select(
        F.coalesce(seconds_between(now, F.col("t")), F.lit(0.0)).alias("tick_lag_seconds"),
        F.coalesce(seconds_between(now, F.col("i")), F.lit(0.0)).alias("insert_lag_seconds"),
    )


def data_gaps(ticks: DataFrame, max_gap_seconds: int = 60, keys: tuple[str, ...] = ("symbol",)) -> DataFrame:
    """Pauses longer than `max_gap_seconds` between neighbouring ticks of a key.

    Two ticks in one bucket of that length are never too far apart, so first and last tick of each bucket are enough;
    buckets meet their neighbours slice by slice, a fixed number of buckets in each, so a busy key is no single task.
    """
    ends = ticks.groupBy(*keys, bucket_start("time", f"{max_gap_seconds} seconds").alias("bucket")).agg(
        F.min("time").alias("first"), F.max("time").alias("last")
    )
    gap = seconds_between(F.col("first"), F.col("previous_time"))
    return (
        with_previous(ends, list(keys), ["bucket"], {"last": "previous_time"}, by=in_steps("bucket", max_gap_seconds * 1_000_000))
        .select(*keys, F.col("previous_time").alias("gap_start"), F.col("first").alias("gap_end"),
                gap.alias("gap_seconds"))
        .filter(F.col("gap_seconds") > max_gap_seconds)
    )


def threshold_flags(ticks: DataFrame, lag: DataFrame, lookback: str = "10 seconds", as_of=None) -> DataFrame:
    """Alarm flags on tick lag, message count and broker lag (`lag` from `consumer_lag`)."""
    broker = lag.agg(F.coalesce(F.sum("lag"), F.lit(0)).cast("long").alias("broker_lag"))
    return side_by_side(ingest_lag(ticks, as_of), recent_activity(ticks, lookback, as_of), broker).select(
        (F.col("tick_lag_seconds") > MAX_LAG_SECONDS).alias("high_lag"),
        (F.col("recent_messages") < MIN_RECENT_MESSAGES).alias("low_throughput"),
        (F.col("broker_lag") > MAX_BROKER_LAG).alias("high_broker_lag"),
    )


def raw_exists(ticks: DataFrame) -> DataFrame:
    return ticks.limit(1).agg((F.count("*") > 0).alias("raw_exists"))


# --- throughput ------------------------------------------------------------------------------------------------


def row_bytes(columns: list[str]) -> Column:
    """Row size measure: bytes of the columns as text, joined by '|'. Times are cut to seconds."""
    parts = [
        F.date_format(c, "yyyy-MM-dd HH:mm:ss") if c in ("time", "inserted_at") else F.col(c).cast("string")
        for c in columns
    ]
    return F.octet_length(F.concat_ws("|", *parts))


ROW_COLUMNS = ["time", "symbol", "price", "volume", "bid", "ask", "exchange", "inserted_at"]


def write_throughput(ticks: DataFrame, lookback: str = "5 minutes", as_of=None, limit: int | None = None) -> DataFrame:
    """Rows and volume written per minute of insertion, newest first."""
    per_minute = (
        recent(ticks, "inserted_at", lookback, as_of)
        .groupBy(bucket_start("inserted_at", "1 minute").alias("minute"))
        .agg(F.count("*").alias("records"), F.count_distinct("symbol").alias("symbols"),
             F.sum(row_bytes(ROW_COLUMNS)).alias("bytes"))
    )
    size = F.col("bytes")
    rows = per_minute.select(
        "minute",
        "records",
        "symbols",
        F.round(F.col("records") / 60, 2).alias("records_per_second"),
        F.round(size / F.col("records"), 2).alias("avg_row_bytes"),
        F.round(to_mebibytes(size), 4).alias("mb_written"),
        F.round(to_mebibytes(size) / 60, 6).alias("mb_per_second"),
    ).orderBy(F.desc("minute"))
    return rows if limit is None else rows.limit(limit)


def register_write_throughput(spark: SparkSession, view: str, name: str = "get_write_throughput") -> None:
    """SQL table function `name(interval_minutes, as_of)` over a view of the log."""
    size = "octet_length(concat_ws('|', " + ", ".join(
        f"date_format({c}, 'yyyy-MM-dd HH:mm:ss')" if c in ("time", "inserted_at") else f"CAST({c} AS STRING)"
        for c in ROW_COLUMNS
    ) + "))"
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {name}(interval_minutes INT, as_of TIMESTAMP)
        RETURNS TABLE(time_window TIMESTAMP, records_written BIGINT, records_per_second DOUBLE,
                      mb_written DOUBLE, mb_per_second DOUBLE)
        RETURN
          SELECT date_trunc('minute', inserted_at), count(*), CAST(round(count(*) / 60, 2) AS DOUBLE),
                 CAST(round(sum({size}) / 1048576, 4) AS DOUBLE),
                 CAST(round(sum({size}) / 1048576 / 60, 6) AS DOUBLE)
          FROM {view}
          WHERE inserted_at > as_of - make_interval(0, 0, 0, 0, 0, interval_minutes, 0) AND inserted_at <= as_of
          GROUP BY date_trunc('minute', inserted_at)
    """)


def table_stats(ticks: DataFrame, lookback: str = "5 minutes", as_of=None) -> DataFrame:
    return recent(ticks, "inserted_at", lookback, as_of).agg(
        F.count("*").alias("total_records"),
        F.max("inserted_at").alias("last_insert"),
        F.count_distinct("symbol").alias("unique_symbols"),
    )


def throughput_delta(ticks: DataFrame, sample: str = "10 minutes") -> DataFrame:
    """Change of the row count from one sample interval to the next, never below 0, as rows per second.

    One row per interval remains, and intervals meet their neighbours slice by slice.
    """
    counts = ticks.groupBy(bucket_start("inserted_at", sample).alias("sampled_at")).agg(F.count("*").alias("records"))
    delta = F.greatest(F.lit(0).cast("long"), F.col("records") - F.coalesce("before", F.lit(0)))
    beside = with_previous(counts, [], ["sampled_at"], {"records": "before"}, by=in_steps("sampled_at", micros(sample)))
    return beside.select("sampled_at", "records", delta.alias("delta_records")).withColumn(
        "records_per_second", F.round(F.col("delta_records") / (micros(sample) / 1_000_000), 6)
    )


def message_throughput(messages: DataFrame, per: str = "1 minute") -> DataFrame:
    """Messages and bytes per interval and topic, with rates."""
    seconds = micros(per) / 1_000_000
    return (
        messages.groupBy("topic", bucket_start("timestamp", per).alias("interval_start"))
        .agg(F.count("*").alias("messages"), F.sum(F.octet_length("value")).alias("bytes"))
        .withColumns({
            "messages_per_second": F.round(F.col("messages") / seconds, 6),
            "bytes_per_second": F.round(F.col("bytes") / seconds, 6),
            "mb_per_second": F.round(to_mebibytes(F.col("bytes")) / seconds, 9),
        })
    )


def consumer_lag(messages: DataFrame, committed: DataFrame) -> DataFrame:
    """Per partition: end of log, next offset to read and the messages in between; never negative."""
    ends = messages.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("high_water"))
    joined = ends.join(committed.select("topic", "partition", "next_offset"), ["topic", "partition"], "left")
    position = F.coalesce("next_offset", F.lit(0).cast("long"))
    return joined.select(
        "topic", "partition", "high_water", position.alias("next_offset"),
        F.greatest(F.lit(0).cast("long"), F.col("high_water") - position).alias("lag"),
    )


def histogram(df: DataFrame, value: Column, bounds: tuple) -> DataFrame:
    """Cumulative counts `value <= le`, one row per bound plus +Infinity, from one aggregate row."""
    edges = [*map(float, bounds), float("inf")]
    counts = df.select(value.cast("double").alias("v")).agg(
        *[F.count_if(F.col("v") <= edge).alias(f"b{i}") for i, edge in enumerate(edges)]
    )
    pairs = [F.struct(F.lit(edge).alias("le"), F.col(f"b{i}").alias("cumulative_count")) for i, edge in enumerate(edges)]
    return counts.select(F.explode(F.array(*pairs)).alias("p")).select("p.*")


def latency_histogram(ticks: DataFrame, bounds: tuple = LATENCY_BUCKETS) -> DataFrame:
    return histogram(ticks, seconds_between(F.col("inserted_at"), F.col("time")), bounds)


def batch_size_histogram(progress: DataFrame, bounds: tuple = BATCH_SIZE_BUCKETS) -> DataFrame:
    """Sizes of the batches that streams have written, from the rows that `ProgressLog` keeps of them."""
    return histogram(progress.filter("input_rows > 0"), F.col("input_rows"), bounds)


def counter_rate(
    samples: DataFrame, keys: tuple[str, ...] = ("counter",), window: str = "5 minutes", every: str = "15 seconds"
) -> DataFrame:
    """Per-second rate of counters over the window before each sample (`sampled_at`, `value` per key).

    A value below its predecessor is a restart: the counter then grew by its whole new value. The growth is added up
    along the key, slice by slice, and the rate is the difference between the total at the sample and the total where
    its window begins, which an as-of look-up finds; `every` is the scrape interval that slices are made of. So a
    counter of any length and any window needs no task of its own.
    """
    keys, span = list(keys), micros(window)
    by = in_steps("sampled_at", micros(every))
    previous = with_previous(samples, keys, ["sampled_at"], {"value": "_previous"}, by=by)
    fallen = F.col("value") < F.col("_previous")
    growth = F.when(~F.col("has_previous"), 0).when(fallen, F.col("value")).otherwise(F.col("value") - F.col("_previous"))
    grown = previous.withColumn("_growth", growth.cast("decimal(28,6)")).drop("_previous", "has_previous")
    totals = ordered.running_totals(grown, keys, ["sampled_at"], {"_growth": "_total"}, by=by)
    at = F.unix_micros("sampled_at")
    asked = totals.drop("_growth").withColumn("_begin", at - span)
    told = totals.select(*keys, at.alias("_told_at"), F.col("_total").alias("_total_then"))
    met = as_of(asked, told, keys, "_begin", "_told_at", {"_total_then": "_before"})
    rate = (F.col("_total") - F.coalesce("_before", F.lit(0))).cast("double") / (span / 1_000_000)
    return met.withColumn("per_second", F.round(rate, 6)).drop("_total", "_before", "_begin")


def success_ratio(rates: DataFrame, good: str, total: str, key: str = "counter") -> DataFrame:
    """rate(good) / rate(total) per sample; NULL while nothing happens."""
    both = rates.groupBy("sampled_at").agg(
        F.sum(F.when(F.col(key) == good, F.col("per_second"))).alias("good"),
        F.sum(F.when(F.col(key) == total, F.col("per_second"))).alias("total"),
    )
    return both.select("sampled_at", F.round(safe_divide("good", "total"), 6).alias("ratio"))


def throughput_report(ticks: DataFrame, messages: DataFrame, rejects: DataFrame, lag: DataFrame) -> DataFrame:
    """One row: totals and mean rates of broker and log over the time they cover."""
    log = ticks.agg(
        F.count("*").alias("records"),
        F.sum(row_bytes(ROW_COLUMNS)).alias("record_bytes"),
        seconds_between(F.max("inserted_at"), F.min("inserted_at")).alias("log_seconds"),
    )
    broker = messages.agg(
        F.count("*").alias("messages"),
        F.sum(F.octet_length("value")).alias("message_bytes"),
        seconds_between(F.max("timestamp"), F.min("timestamp")).alias("broker_seconds"),
    )
    errors = rejects.agg(F.count("*").alias("errors"))
    behind = lag.agg(F.coalesce(F.sum("lag"), F.lit(0)).cast("long").alias("lag_messages"))
    return side_by_side(log, broker, errors, behind).select(
        "messages", "message_bytes", "errors", "lag_messages", "records", "record_bytes",
        F.round(safe_divide("messages", "broker_seconds"), 6).alias("messages_per_second"),
        F.round(safe_divide(to_mebibytes(F.col("message_bytes")), "broker_seconds"), 9).alias("message_mb_per_second"),
        F.round(safe_divide("records", "log_seconds"), 6).alias("records_per_second"),
        F.round(safe_divide(to_mebibytes(F.col("record_bytes")), "log_seconds"), 9).alias("record_mb_per_second"),
    )


def state_counts(rows: DataFrame, state: str, states: list[str]) -> DataFrame:
    """Total and one count per state in a single pass."""
    return rows.agg(F.count("*").alias("total"), *[F.count_if(F.col(state) == s).alias(s) for s in states])


# --- candle validation -----------------------------------------------------------------------------------------


def ohlcv_coverage(candles: DataFrame, lookback: str = "24 hours", as_of=None) -> DataFrame:
    return recent(candles, "period_start", lookback, as_of).agg(
        F.count("*").alias("period_count"),
        F.count_distinct("symbol").alias("symbol_count"),
        F.min("period_start").alias("earliest"),
        F.max("period_start").alias("latest"),
    )


def ohlcv_anomalies(candles: DataFrame, lookback: str = "24 hours", as_of=None) -> DataFrame:
    """Candles that cannot be right, per symbol."""
    impossible = (F.col("high") < F.col("low")) | (F.col("close") < 0) | (F.col("total_volume") < 0)
    bad = recent(candles, "period_start", lookback, as_of).filter(impossible)
    return bad.groupBy("symbol").agg(F.count("*").alias("anomaly_count"))


def missing_periods(
    candles: DataFrame, lookback: str = "24 hours", as_of=None, step: str = "15 minutes"
) -> DataFrame:
    """Periods of the lookback without any candle; the period that starts at `as_of` counts as expected."""
    now = as_of_column(as_of)
    first, last = bucket_start(plus(now, lookback, -1), step), bucket_start(now, step)
    begin, end = candles.sparkSession.range(1).select(F.unix_micros(first), F.unix_micros(last)).first()
    width = micros(step)
    steps = candles.sparkSession.range((end - begin) // width + 1)  # made in parallel, whatever the lookback
    spine = steps.select(F.timestamp_micros(F.lit(begin) + F.col("id") * width).alias("period_start"))
    first, last = F.timestamp_micros(F.lit(begin)), F.timestamp_micros(F.lit(end))
    seen = candles.filter(F.col("period_start").between(first, last)).select("period_start").distinct()
    return spine.join(seen, "period_start", "left_anti")


def validation_summary(
    candles: DataFrame, lookback: str = "24 hours", as_of=None, step: str = "15 minutes"
) -> DataFrame:
    """One row per validation: what was found and whether it passed."""
    coverage = ohlcv_coverage(candles, lookback, as_of)
    anomalies = ohlcv_anomalies(candles, lookback, as_of)
    missing = missing_periods(candles, lookback, as_of, step)

    def line(found: DataFrame, name: str, passed: Column) -> DataFrame:
        outcome = F.when(passed, "passed").otherwise("failed").alias("outcome")
        return found.select(F.lit(name).alias("validation"), F.col("found").cast("long").alias("found"), outcome)

    return reduce(DataFrame.unionByName, [
        line(coverage.select(F.col("period_count").alias("found")), "candles_exist", F.col("found") > 0),
        line(anomalies.agg(F.coalesce(F.sum("anomaly_count"), F.lit(0)).alias("found")), "no_anomalies",
             F.col("found") == 0),
        line(missing.agg(F.count("*").alias("found")), "no_missing_periods", F.col("found") == 0),
    ])


def quality_report(candles: DataFrame, lookback: str = "24 hours", as_of=None) -> DataFrame:
    """Close-price statistics per symbol."""
    return recent(candles, "period_start", lookback, as_of).groupBy("symbol").agg(
        F.count("*").alias("data_points"),
        F.avg("close").alias("avg_price"),
        F.stddev_samp(F.col("close").cast("double")).alias("price_stddev"),
        F.min("close").alias("min_price"),
        F.max("close").alias("max_price"),
        F.sum("total_volume").alias("total_volume"),
    )


def running_totals(counts: DataFrame, columns: list[str], time: str = "sampled_at") -> DataFrame:
    """Counts per interval -> monotone counters, one row per (counter, sample).

    Sums run within a day and start from the total of the days before: only days meet in one task.
    """
    named = {c: f"_{c}" for c in columns}
    totals = ordered.running_totals(counts.select(time, *columns), [], [time], named, by=F.to_date(time))
    return totals.select(time, *[F.col(t).alias(c) for c, t in named.items()]).unpivot([time], columns, "counter", "value")
