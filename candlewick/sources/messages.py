"""JSON messages <-> ticks. All functions work on batch and streaming DataFrames alike."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.schema import DEFAULT_EXCHANGE, PRICE, VOLUME

ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def parse_messages(messages: DataFrame, value: str = "value") -> DataFrame:
    """Add the tick columns and `problem` (NULL for a usable tick) to a message DataFrame.

    The payload is read as a map in one pass: a map tells an absent field (takes the default) from an explicit null
    (stays NULL), and numbers arrive as text, so decimals never go through a float. A number that is there but
    unusable makes a reject. The place in the message log gives `id`, its time there `inserted_at`.
    """
    body = F.col("_body")
    place = [message_id().alias("id")] if {"topic", "partition", "offset"} <= set(messages.columns) else []
    arrival = [F.col("timestamp").alias("inserted_at")] if "timestamp" in messages.columns else []

    def field(name: str) -> Column:
        return F.element_at(body, F.lit(name))

    def field_or(name: str, default: str) -> Column:
        return F.when(F.map_contains_key(body, name), field(name)).otherwise(F.lit(default))

    def number(text: Column, kind) -> Column:
        return text.try_cast(kind)

    # The one-element explode keeps the optimizer from copying the JSON parse into every filter on its fields.
    once = F.explode(F.array(F.from_json(F.col(value).cast("string"), "map<string,string>")))
    parsed = messages.withColumn("_body", once)
    parsed = parsed.select(
        *messages.columns,
        "_body",
        *place,
        *arrival,
        field("timestamp").try_cast("timestamp").alias("time"),
        field("symbol").alias("symbol"),
        number(field("price"), PRICE).alias("price"),
        number(field_or("volume", "0"), VOLUME).alias("volume"),
        number(field("bid"), PRICE).alias("bid"),
        number(field("ask"), PRICE).alias("ask"),
        field_or("source", DEFAULT_EXCHANGE).alias("exchange"),
    )

    def unusable(name: str) -> Column:
        return field(name).isNotNull() & F.col(name).isNull()

    problem = (
        F.when(body.isNull(), "malformed json")
        .when(F.col("time").isNull(), "no usable timestamp")
        .when(F.col("symbol").isNull(), "no symbol")
        .when(F.col("price").isNull(), "no usable price")
        .when(unusable("volume"), "no usable volume")
        .when(unusable("bid"), "no usable bid")
        .when(unusable("ask"), "no usable ask")
    )
    return parsed.withColumn("problem", problem).drop("_body")


def message_id() -> Column:
    """Ingest sequence of a message: its offset, then 20 bits that tell topics and partitions apart.

    Within a partition ids ascend with the offset; the same message has the same id in every run. Two partitions may
    share their 20 bits (likely from about a thousand partitions on), and then messages of one offset share an id; offsets
    from 2^43 on overflow. Ids only order ticks of one instant, so neither loses a tick.
    """
    partition = F.md5(F.concat_ws("/", "topic", F.col("partition").cast("string")))
    return F.col("offset") * F.lit(1 << 20) + F.conv(F.substring(partition, 1, 5), 16, 10).cast("long")


def accepted(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("problem").isNull()).drop("problem")


def rejected(parsed: DataFrame) -> DataFrame:
    """The dead letters: the untouched message and why it was refused."""
    tick_columns = ["id", "inserted_at", "time", "symbol", "price", "volume", "bid", "ask", "exchange"]
    return parsed.filter(F.col("problem").isNotNull()).drop(*tick_columns)


def normalise_quotes(payloads: DataFrame, payload: str = "payload") -> DataFrame:
    """Nested spot-quote payload {"data": {"amount", "currency"}} -> flat price and currency columns."""
    quote = F.from_json(F.col(payload), "data struct<amount:string,currency:string>")
    return (
        payloads.withColumn("_quote", quote)
        .withColumn("price", F.col("_quote.data.amount").try_cast("double"))
        .withColumn("currency", F.col("_quote.data.currency"))
        .drop("_quote", payload)
    )


def message_key(symbol: str = "symbol", timestamp: str = "timestamp") -> Column:
    """Same tick, same key: lets any later stage drop redelivered messages."""
    return F.concat_ws("_", F.col(symbol), F.col(timestamp))


def encode_messages(ticks: DataFrame, fields: list[str], time: str = "time") -> DataFrame:
    """Ticks -> `key`, `value`, ready for a Kafka sink. `time` becomes the ISO text field `timestamp`."""
    stamped = ticks.withColumn("timestamp", F.date_format(time, ISO_MICROS))
    return stamped.select(message_key().alias("key"), F.to_json(F.struct(*fields)).alias("value"))


def drop_redelivered(messages: DataFrame, key: str = "key") -> DataFrame:
    """Keep the first delivery per key, by (topic, partition, offset)."""
    first = F.min_by(F.struct(*messages.columns), F.struct("topic", "partition", "offset"))
    return messages.groupBy(F.col(key).alias("_key")).agg(first.alias("m")).select("m.*")


def after_committed(messages: DataFrame, committed: DataFrame) -> DataFrame:
    """Messages a consumer group has still to read: `committed` holds the next offset per (topic, partition).

    A partition without a committed offset is read from its start.
    """
    position = committed.select("topic", "partition", F.col("next_offset").alias("_next"))
    joined = messages.join(position, ["topic", "partition"], "left")
    return joined.filter(F.col("offset") >= F.coalesce("_next", F.lit(0))).drop("_next")
