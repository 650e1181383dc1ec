"""Column contracts of the tick log and of the broker messages in front of it."""

from __future__ import annotations

from pyspark.sql import types as T

PRICE = T.DecimalType(20, 8)
VOLUME = T.DecimalType(30, 8)
# Fixed value: the exchange of a tick that names none.
DEFAULT_EXCHANGE = "coinbase"

# One row per accepted tick; `id` is the ingest sequence, used only to order ticks of the same instant.
TICK_LOG = T.StructType(
    [
        T.StructField("id", T.LongType(), False),
        T.StructField("time", T.TimestampType(), False),
        T.StructField("symbol", T.StringType(), False),
        T.StructField("price", PRICE, False),
        T.StructField("volume", VOLUME),
        T.StructField("bid", PRICE),
        T.StructField("ask", PRICE),
        T.StructField("exchange", T.StringType()),
        T.StructField("inserted_at", T.TimestampType()),
    ]
)

# Same column names as the Kafka source, so a file log and a topic are interchangeable.
MESSAGES = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)

REQUIRED = ("id", "time", "symbol", "price")
MAX_LENGTH = {"symbol": 20, "exchange": 50}


class SchemaDrift(ValueError):
    """A batch does not have the columns of the table it should be written to."""


def check_same_columns(batch: T.StructType, target: T.StructType) -> None:
    """Raise when names or types differ; column order and nullability do not matter."""
    have = {f.name.lower(): f.dataType.simpleString() for f in batch}
    want = {f.name.lower(): f.dataType.simpleString() for f in target}
    if have != want:
        added = sorted(set(have) - set(want))
        missing = sorted(set(want) - set(have))
        changed = sorted(c for c in set(have) & set(want) if have[c] != want[c])
        raise SchemaDrift(f"added {added}, missing {missing}, type changed {changed}")
