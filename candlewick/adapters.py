"""The driver's `events` table seen as price ticks and as broker messages."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.schema import DEFAULT_EXCHANGE, PRICE, VOLUME
from candlewick.sources.messages import ISO_MICROS, encode_messages
from candlewick.streaming.jobs import file_stream

AS_OF = dt.datetime(2024, 1, 31)
SPAN = "31 days"  # reaches back over the whole table from AS_OF
PARTITIONS = 6
BROKEN_EVERY = 50


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`events` as a file stream; the one-letter pattern lets the source accept a single file as well as a folder."""
    schema = table(spark, sf_dir, "events").schema
    return file_stream(spark, f"{sf_dir}/event[s].parquet", schema)


def ticks_of(events: DataFrame) -> DataFrame:
    price = F.col("value").cast(PRICE)
    third = F.pmod(F.col("event_id"), F.lit(3))
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    return events.select(
        F.col("event_id").alias("id"),
        F.col("ts").cast("timestamp").alias("time"),
        F.col("event_type").alias("symbol"),
        price.alias("price"),
        F.get_json_object("props", "$.k").cast(VOLUME).alias("volume"),
        (price * F.expr("0.999BD")).cast(PRICE).alias("bid"),
        (price * F.expr("1.001BD")).cast(PRICE).alias("ask"),
        F.when(third != 0, F.concat(F.lit("ex"), third.cast("string"))).alias("exchange"),
        F.timestamp_micros(us + F.pmod(F.col("event_id"), F.lit(120)) * 1_000_000).alias("inserted_at"),
    )


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ticks_of(table(spark, sf_dir, "events"))


def messages_of(events: DataFrame) -> DataFrame:
    """JSON messages in two topics of six partitions; every 50th payload is cut off, as a broken producer would."""
    source = ticks_of(events).select(
        "id",
        "time",
        "symbol",
        F.col("price").cast("double").alias("price"),
        F.col("volume").cast("long").alias("volume"),
        F.col("bid").cast("double").alias("bid"),
        F.col("ask").cast("double").alias("ask"),
        F.coalesce("exchange", F.lit(DEFAULT_EXCHANGE)).alias("source"),
        F.lit("USD").alias("currency"),
        F.date_format("time", ISO_MICROS).alias("timestamp"),
    )
    fields = ["symbol", "price", "volume", "bid", "ask", "currency", "timestamp", "source"]
    value = F.to_json(F.struct(*fields))
    broken = F.pmod(F.col("id"), F.lit(BROKEN_EVERY)) == 0
    return source.select(
        F.concat_ws("_", "symbol", "timestamp").alias("key"),
        F.when(broken, F.substring(value, 1, 20)).otherwise(value).alias("value"),
        F.when(F.pmod(F.col("id"), F.lit(2)) == 0, "ticks").otherwise("ticks_alt").alias("topic"),
        F.pmod(F.col("id"), F.lit(PARTITIONS)).cast("int").alias("partition"),
        F.expr(f"id div {PARTITIONS}").alias("offset"),
        F.col("time").alias("timestamp"),
    )


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages_of(table(spark, sf_dir, "events"))


def encoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key and value the way the producer writes them."""
    source = ticks(spark, sf_dir).select(
        "time", "symbol", F.col("price").cast("double").alias("price"), F.lit("USD").alias("currency"),
        F.lit("spot").alias("source"), F.pmod(F.col("id"), F.lit(100)).alias("fetch_latency_ms"),
    )
    return encode_messages(source, ["symbol", "price", "currency", "timestamp", "source", "fetch_latency_ms"])
