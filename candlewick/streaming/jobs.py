"""Streams over a message log. A Kafka topic and a folder of message files have the same columns."""

from __future__ import annotations

import ast
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery, StreamingQueryListener

from candlewick.functions.times import micros
from candlewick.plans.candles import WIDTH, trade_statistics
from candlewick.schema import MESSAGES
from candlewick.sources import message_log
from candlewick.sources.log import DAY, path_exists, to_log_rows, upsert
from candlewick.sources.messages import accepted, parse_messages
from candlewick.sources.scratch import new_folder
from candlewick.streaming.log_source import MessageLog

# Longest wait before a batch is written, and the rows that make a batch full.
FLUSH_INTERVAL, FLUSH_ROWS = "5 seconds", 100


def kafka_messages(
    spark: SparkSession, servers: str, topics: list[str], starting: str = "earliest", max_rows: int | None = None
) -> DataFrame:
    """Several topics in one stream; `topic` tells them apart. Offsets live in the query's checkpoint."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", ",".join(topics))
        .option("startingOffsets", starting)
    )
    if max_rows:
        reader = reader.option("maxOffsetsPerTrigger", max_rows)
    return reader.load().withColumns({"key": F.col("key").cast("string"), "value": F.col("value").cast("string")})


def logged_messages(
    spark: SparkSession,
    path: str,
    topics: list[str] | None = None,
    starting: str = "earliest",
    max_rows: int | None = None,
    flush_seconds: float | None = None,
    position: str | None = None,
) -> DataFrame:
    """A message log as a stream: batches of `max_rows` messages, or of fewer once they have waited `flush_seconds`.

    Without `flush_seconds` a batch takes what is there, `max_rows` at most.
    """
    spark.dataSource.register(MessageLog)
    reader = spark.readStream.format(MessageLog.name()).option("path", path).option("startingOffsets", starting)
    options = {"subscribe": ",".join(topics or []), "maxOffsetsPerTrigger": max_rows, "position": position}
    if flush_seconds is not None:
        options |= {"minOffsetsPerTrigger": max_rows, "maxTriggerDelay": flush_seconds}
    for name, value in options.items():
        if value:
            reader = reader.option(name, value)
    return reader.load()


def file_stream(
    spark: SparkSession, path: str, schema: T.StructType = MESSAGES, max_files: int | None = None
) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def start(
    writer: DataStreamWriter, spark: SparkSession, checkpoint: str | None = None, every: str | None = None
) -> StreamingQuery:
    """Start with a trigger interval, or process what is there and stop. The checkpoint resumes an earlier run."""
    writer = writer.option("checkpointLocation", checkpoint or new_folder(spark, "stream"))
    return writer.trigger(processingTime=every).start() if every else writer.trigger(availableNow=True).start()


def run_bounded(query: StreamingQuery, seconds: int | None = None) -> StreamingQuery:
    """Wait for the end of an availableNow run, or for `seconds` and then stop; a started batch is finished."""
    if seconds is None:
        query.awaitTermination()
    elif not query.awaitTermination(seconds):
        query.stop()
    return query


def drained(query: StreamingQuery, path: str, seconds: float = 3600) -> StreamingQuery:
    """Wait until a stream over the message log at `path` has written what the log holds now, then stop it.

    Unlike with availableNow, which takes all in one batch, the batches keep to their limits of rows and seconds.
    """
    held = message_log.ends(SparkSession.active(), path).collect()  # one row for each (topic, partition)
    deadline = time.monotonic() + seconds
    while query.isActive and time.monotonic() < deadline:
        query.processAllAvailable()
        last = query.lastProgress
        reached = ast.literal_eval(last["sources"][0]["endOffset"] or "{}") if last else {}  # progress shows a dict
        if all((reached or {}).get(f"{r.topic}/{r.partition}", -1) >= r.next_offset for r in held):
            break
        time.sleep(0.1)
    query.stop()
    if query.exception():
        raise query.exception()
    return query


def append_ticks(messages: DataFrame, path: str, checkpoint: str | None = None, every: str | None = None):
    """Messages -> rows of the tick log, per day. The file sink commits a batch once, so a repeated one adds nothing."""
    rows = to_log_rows(accepted(parse_messages(messages))).withColumn(DAY, F.to_date("time"))
    writer = rows.writeStream.format("parquet").outputMode("append").partitionBy(DAY).option("path", path)
    return start(writer, messages.sparkSession, checkpoint, every)


def first_deliveries(messages: DataFrame, delay: str = "2 hours") -> DataFrame:
    """Drop messages whose key was seen before; keys are remembered for `delay`."""
    return messages.withWatermark("timestamp", delay).dropDuplicatesWithinWatermark(["key"])


def write_stream(
    rows: DataFrame, path: str, checkpoint: str | None = None, every: str | None = None
) -> StreamingQuery:
    writer = rows.writeStream.format("parquet").outputMode("append").option("path", path)
    return start(writer, rows.sparkSession, checkpoint, every)


def candle_stream(
    ticks: DataFrame, delay: str = "2 hours", width: str = WIDTH, keys: tuple[str, ...] = ("symbol", "exchange")
) -> DataFrame:
    """Candles per event-time window; a tick later than `delay` is left out."""
    period = F.window("time", f"{micros(width)} microseconds")
    grouped = ticks.withWatermark("time", delay).groupBy(period.alias("period"), *keys).agg(*trade_statistics())
    return grouped.withColumn("bucket", F.col("period.start")).drop("period")


def upsert_stream(
    rows: DataFrame, path: str, keys: list[str], day_of: str, checkpoint: str | None = None, every: str | None = None
) -> StreamingQuery:
    """Keep a table up to date with changed rows. Replaying a batch replaces the same keys: the result is the same."""

    def write(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            upsert(batch.withColumn(DAY, F.to_date(day_of)), path, keys)

    writer = rows.writeStream.outputMode("update").foreachBatch(write)
    return start(writer, rows.sparkSession, checkpoint, every)


PROGRESS = (
    "query string, batch_id long, input_rows long, input_rows_per_second double, processed_rows_per_second double"
)


class ProgressLog(StreamingQueryListener):
    """Keeps the progress of every batch of the session's streams, from the moment it is added to the session.

    A query's own `recentProgress` forgets all but the last batches. With a `path`, every `keep` batches are appended to
    a table there, so a stream of months holds no more than that in memory; without one, `write` empties the memory.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, keep: int = 1000):
        self.spark, self.path, self.keep, self.rows = spark, path, keep, []
        self.reported: dict[str, int] = {}  # newest batch by query
        spark.streams.addListener(self)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        rates = (float(p.inputRowsPerSecond or 0), float(p.processedRowsPerSecond or 0))
        self.rows.append((str(p.id), p.batchId, p.numInputRows, *(0.0 if r != r else r for r in rates)))
        if self.path and len(self.rows) >= self.keep:
            self.write(self.path)
        self.reported[str(p.id)] = p.batchId

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def close(self) -> None:
        self.spark.streams.removeListener(self)

    def _all(self) -> DataFrame:
        kept = self.spark.createDataFrame(self.rows, PROGRESS)
        return kept.unionByName(self.spark.read.schema(PROGRESS).parquet(self.path)) if self._written() else kept

    def _written(self) -> bool:
        return self.path is not None and path_exists(self.spark, self.path)

    def throughput(self, query: StreamingQuery) -> DataFrame:
        """Rows and rates of every finished batch of a query; a report may come a moment after its batch."""
        last = query.lastProgress
        deadline = time.monotonic() + 10
        while last and self.reported.get(str(query.id), -1) < last["batchId"] and time.monotonic() < deadline:
            time.sleep(0.05)
        return self._all().filter(F.col("query") == str(query.id)).drop("query")

    def write(self, path: str) -> None:
        """Append what was kept to a table of all queries and forget it."""
        kept, self.rows = self.rows, []
        self.spark.createDataFrame(kept, PROGRESS).coalesce(1).write.mode("append").parquet(path)


def observed(messages: DataFrame, name: str = "throughput") -> DataFrame:
    """Count messages and bytes while they pass; the numbers arrive with the progress reports."""
    return messages.observe(name, F.count("*").alias("messages"), F.sum(F.octet_length("value")).alias("bytes"))
