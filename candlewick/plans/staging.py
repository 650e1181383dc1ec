"""Cleaned ticks with spreads: the input of every model."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.schema import DEFAULT_EXCHANGE, PRICE, VOLUME
from candlewick.sources.log import DAY


def staged_ticks(raw: DataFrame, quotes: str = "passthrough") -> DataFrame:
    """Typed, valid ticks. `quotes="null"` blanks bid and ask; the default keeps them, so spreads can be computed.

    The spread share is relative to the ask. Ticks read from the log keep their day, by which later time filters skip
    folders.
    """
    if quotes not in ("passthrough", "null"):
        raise ValueError("quotes must be 'passthrough' or 'null'")

    def quote(name: str):
        source = F.col(name) if quotes == "passthrough" else F.lit(None)
        return source.cast(PRICE).alias(name)

    typed = raw.select(
        "id",
        "time",
        "symbol",
        F.col("price").cast(PRICE).alias("price"),
        F.col("volume").cast(VOLUME).alias("volume"),
        quote("bid"),
        quote("ask"),
        F.coalesce("exchange", F.lit(DEFAULT_EXCHANGE)).alias("exchange"),
        "inserted_at",
        *([DAY] if DAY in raw.columns else []),
    )
    valid = typed.filter((F.col("price") > 0) & F.col("symbol").isNotNull() & F.col("time").isNotNull())
    quoted = (F.col("bid") > 0) & (F.col("ask") > 0)
    spread = F.col("ask") - F.col("bid")
    return valid.withColumns(
        {
            "spread": F.when(quoted, spread),
            "spread_pct": F.when(quoted, spread.cast("double") / F.col("ask").cast("double") * 100),
        }
    )
