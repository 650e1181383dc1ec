"""Bounded streaming runs over the whole event log, read back."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from candlewick.adapters import event_stream, messages, messages_of, ticks, ticks_of
from candlewick.plans.monitor import batch_size_histogram as batch_sizes
from candlewick.plans.staging import staged_ticks
from candlewick.queries.base import CANDLE_X_NUMBERS, query, sql
from candlewick.queries.ingest import LOG_NUMBERS
from candlewick.queries.models import ALERT_NUMBERS, ALERTS
from candlewick.schema import DEFAULT_EXCHANGE
from candlewick.sources.log import DAY, to_log_rows
from candlewick.sources.message_log import append_messages, ends
from candlewick.sources.scratch import new_folder
from candlewick.streaming import jobs, late
from candlewick.streaming.alerts import alert_stream, rocksdb_state

# Longer than the log: the files of a folder come in any order, and no tick may be dropped as late.
WHOLE_LOG = "60 days"


@query("stream_append", sql("SELECT * FROM ingested", "ingested", LOG_NUMBERS))
def stream_append(spark, sf_dir):
    path = new_folder(spark, "appended")
    jobs.run_bounded(jobs.append_ticks(messages_of(event_stream(spark, sf_dir)), path))
    return spark.read.parquet(path).drop(DAY)


@query("stream_dedup", sql('SELECT key, topic, partition, "offset", timestamp FROM messages', "messages"))
def stream_dedup(spark, sf_dir):
    """Each message arrives twice."""
    path, source = new_folder(spark, "first"), messages_of(event_stream(spark, sf_dir))
    twice = source.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("copy")
    jobs.run_bounded(jobs.write_stream(jobs.first_deliveries(twice, WHOLE_LOG), path))
    return spark.read.parquet(path).drop("value")


@query("stream_ohlcv", sql("SELECT * FROM candles_x", "candles_x", CANDLE_X_NUMBERS))
def stream_ohlcv(spark, sf_dir):
    path = new_folder(spark, "candles")
    source = ticks_of(event_stream(spark, sf_dir)).withColumn(
        "exchange", F.coalesce("exchange", F.lit(DEFAULT_EXCHANGE))
    )
    rows = jobs.candle_stream(source, WHOLE_LOG)
    jobs.run_bounded(jobs.upsert_stream(rows, path, [DAY, "bucket", "symbol", "exchange"], "bucket"))
    return spark.read.parquet(path).drop(DAY)


@query("stream_price_alerts", sql(ALERTS, "stg", ALERT_NUMBERS))
def stream_price_alerts(spark, sf_dir):
    path = new_folder(spark, "alerts")
    alerts = alert_stream(staged_ticks(ticks_of(event_stream(spark, sf_dir))), delay=WHOLE_LOG)
    with rocksdb_state(spark):
        query = jobs.write_stream(alerts, path)
    jobs.run_bounded(query)
    return spark.read.parquet(path)


_PLACES = 'SELECT key, topic, partition, "offset", timestamp FROM messages'


@query("stream_resume", sql(_PLACES, "messages"))
def stream_resume(spark, sf_dir):
    """The message log as a stream, in batches of a sixth of its rows; stopped halfway, resumed when more has come."""
    path, out, mark = (new_folder(spark, n) for n in ("message-log", "resumed", "resumed-mark"))
    source = messages(spark, sf_dir)
    size = source.agg(F.count("*").alias("n"), F.max("offset").alias("last")).first()
    most, cut = max(1, -(-size.n // 6)), (size.last or 0) // 2
    for half in (F.col("offset") < cut, F.col("offset") >= cut):
        append_messages(source.filter(half), path)
        stream = jobs.logged_messages(spark, path, max_rows=most, position=f"{mark}/position.json")
        jobs.drained(jobs.write_stream(stream, out, mark, every="0 seconds"), path)
    return spark.read.parquet(out).drop("value")


@query("stream_latest", sql(f'{_PLACES} WHERE partition % 2 = 1', "messages"))
def stream_latest(spark, sf_dir):
    """A stream that starts at the end of the log reads what comes after its start."""
    path, out, mark = (new_folder(spark, n) for n in ("message-log", "newest", "newest-mark"))
    source = messages(spark, sf_dir)
    append_messages(source.filter("partition % 2 = 0"), path)
    stream = lambda: jobs.logged_messages(spark, path, starting="latest")
    jobs.drained(jobs.write_stream(stream(), out, mark, every="0 seconds"), path)
    append_messages(source.filter("partition % 2 = 1"), path)
    jobs.drained(jobs.write_stream(stream(), out, mark, every="0 seconds"), path)
    return spark.read.parquet(out).drop("value")


@query(
    "stream_replay",
    sql(
        """SELECT m.key, m.topic, m.partition, m."offset" FROM messages m
           JOIN (SELECT topic, partition, max("offset") // 2 AS pos FROM messages WHERE partition < 4 GROUP BY ALL) c
             ON m.topic = c.topic AND m.partition = c.partition WHERE m."offset" >= c.pos
           UNION ALL SELECT key, topic, partition, "offset" FROM messages WHERE partition >= 4""",
        "messages",
    ),
)
def stream_replay(spark, sf_dir):
    """A stream from given offsets; partitions that are not named start at the beginning."""
    path, out, mark = (new_folder(spark, n) for n in ("message-log", "replayed", "replayed-mark"))
    append_messages(messages(spark, sf_dir), path)
    start: dict = {}
    for r in ends(spark, path).filter("partition < 4").collect():
        start.setdefault(r.topic, {})[str(r.partition)] = (r.next_offset - 1) // 2
    stream = jobs.logged_messages(spark, path, starting=json.dumps(start))
    jobs.drained(jobs.write_stream(stream, out, mark, every="0 seconds"), path)
    return spark.read.parquet(out).select("key", "topic", "partition", "offset")


@query(
    "batch_size_histogram",
    sql(
        """SELECT le, (SELECT count(*) FROM (
                SELECT least(most, n - i * most) AS size
                FROM (SELECT count(*) AS n, greatest(100, (count(*) + 15) // 16) AS most FROM messages), range(17) r(i)
                WHERE i * most < n) WHERE size <= le) AS cumulative_count
           FROM (SELECT unnest([1, 10, 25, 50, 100, 250, 500, 1000, 'inf'::DOUBLE]::DOUBLE[]) AS le)""",
        "messages",
    ),
)
def batch_size_histogram(spark, sf_dir):
    """Sizes of the flushes of an ingest run: a batch is written once it is full or a second has passed.

    A full batch has the usual number of rows, or a sixteenth of the log where that is more.
    """
    path, out, mark = (new_folder(spark, n) for n in ("message-log", "flushed", "flushed-mark"))
    append_messages(messages(spark, sf_dir), path)
    held = ends(spark, path).agg(F.sum("messages").alias("n")).first().n or 0
    full = max(jobs.FLUSH_ROWS, -(-held // 16))
    progress = jobs.ProgressLog(spark)
    stream = jobs.logged_messages(spark, path, max_rows=full, flush_seconds=1, position=f"{mark}/position.json")
    query = jobs.drained(jobs.append_ticks(stream, out, mark, every="0 seconds"), path)
    rows = progress.throughput(query)
    progress.close()
    return batch_sizes(rows)


@query("stream_late_repair", sql("SELECT * FROM candles_x", "candles_x", CANDLE_X_NUMBERS))
def stream_late_repair(spark, sf_dir):
    """Ticks in four batches with newer days first: candles of the ticks that come in time, then the repair of the
    windows that late ones fall into."""
    path, inbox, out = (new_folder(spark, n) for n in ("split", "split-inbox", "split-candles"))
    rows = to_log_rows(ticks(spark, sf_dir))
    for part in (1, 3, 0, 2):
        rows.filter(F.pmod(F.dayofmonth("time"), F.lit(4)) == part).coalesce(1).write.mode("append").parquet(inbox)
    jobs.run_bounded(late.split_late(jobs.file_stream(spark, inbox, rows.schema, max_files=1), path))
    in_time = jobs.file_stream(spark, f"{path}/{late.ON_TIME}/*", rows.schema)
    stream = jobs.candle_stream(in_time, WHOLE_LOG)
    jobs.run_bounded(jobs.upsert_stream(stream, out, [DAY, "bucket", "symbol", "exchange"], "bucket"))
    late.repair_candles(spark, path, out, rows.schema)
    return spark.read.parquet(out).drop(DAY)
