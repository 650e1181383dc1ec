"""Late ticks kept and repaired.

A windowed stream drops what comes behind its watermark. Here a stream first splits its batches: ticks within `delay` of
the newest time seen in earlier batches go on, all others go to a side table. A repair then recomputes exactly the
windows that late ticks fall into, from both tables, and puts them into the candle table. So stream plus repair give
what one batch over all ticks gives, in whatever order they came.

A batch is written to folders of its own number, and a ledger row with its number and newest time comes last. A batch
that is run again after a crash finds the same watermark (that of the rows with smaller numbers) and replaces its own
folders, so nothing is lost or doubled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from candlewick.functions.times import bucket_start, micros
from candlewick.plans.candles import WIDTH, candles_by
from candlewick.sources.log import DAY, path_exists, upsert
from candlewick.streaming.jobs import start

ON_TIME, LATE, LEDGER, REPAIRED = "on_time", "late", "ledger", "repaired"
_LEDGER = "newest timestamp, batch long"


def _read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A table of batch folders; empty while there is none."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def watermark(spark: SparkSession, path: str, batch: int, delay: str):
    """Newest time of the batches before this one, less the delay; None before the first."""
    ledger = _read(spark, f"{path}/{LEDGER}", T.StructType.fromDDL(_LEDGER))
    newest = F.max(F.unix_micros("newest")) - micros(delay)
    return ledger.filter(F.col("batch") < batch).agg(newest.alias("us")).first().us


def split_late(
    ticks: DataFrame, path: str, delay: str = "2 hours", checkpoint: str | None = None, every: str | None = None
) -> StreamingQuery:
    """Write a stream of ticks to `path/on_time` and `path/late`, one folder for each batch."""

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        limit = watermark(spark, path, number, delay)
        held = batch.persist()
        late = F.lit(False) if limit is None else F.unix_micros("time") < limit
        late = F.coalesce(late, F.lit(False))
        for name, rows in ((ON_TIME, held.filter(~late)), (LATE, held.filter(late))):
            rows.write.mode("overwrite").parquet(f"{path}/{name}/batch={number}")
        newest = held.agg(F.max("time").alias("newest"))
        newest.coalesce(1).write.mode("overwrite").parquet(f"{path}/{LEDGER}/batch={number}")
        held.unpersist()

    return start(ticks.writeStream.foreachBatch(write), ticks.sparkSession, checkpoint, every)


def _batches(spark: SparkSession, path: str, name: str, schema: T.StructType) -> DataFrame:
    return _read(spark, f"{path}/{name}", T.StructType([*schema.fields, T.StructField("batch", T.LongType())]))


def on_time(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return _batches(spark, path, ON_TIME, schema).drop("batch")


def late_ticks(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Late ticks with the number of the batch that found them."""
    return _batches(spark, path, LATE, schema)


def repair_candles(
    spark: SparkSession,
    path: str,
    candles_path: str,
    schema: T.StructType,
    width: str = WIDTH,
    keys: tuple[str, ...] = ("symbol", "exchange"),
) -> int:
    """Recompute the windows of late ticks not repaired yet; returns how many windows there were.

    What is repaired is noted by batch after the candles are written: a run that died is repeated as a whole. Upserts by
    key make that harmless.
    """
    done = _read(spark, f"{path}/{REPAIRED}", T.StructType.fromDDL("batch long"))
    late = late_ticks(spark, path, schema).join(done, "batch", "left_anti")
    numbers = late.select("batch").distinct().persist()
    hit = late.select(bucket_start("time", width).alias("bucket"), *keys).distinct().persist()
    windows = hit.count()
    if windows:
        every = on_time(spark, path, schema).unionByName(late_ticks(spark, path, schema).drop("batch"))
        bucket = bucket_start("time", width)
        wanted = hit.select(F.col("bucket").alias("_bucket"), *[F.col(k).alias(f"_{k}") for k in keys])
        same = bucket == F.col("_bucket")
        for k in keys:
            same &= F.col(k).eqNullSafe(F.col(f"_{k}"))
        fresh = candles_by(every.join(wanted, same, "left_semi"), keys, width).withColumn(DAY, F.to_date("bucket"))
        upsert(fresh, candles_path, [DAY, "bucket", *keys])
        numbers.coalesce(1).write.mode("append").parquet(f"{path}/{REPAIRED}")
    hit.unpersist()
    numbers.unpersist()
    return windows
