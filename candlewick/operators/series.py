"""Number and date series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PARTS = ("second", "minute", "hour", "day", "week", "month", "quarter", "year")


def generate_series(spark: SparkSession, upper_bound: int) -> DataFrame:
    """1..upper_bound, generated in parallel."""
    return spark.range(1, upper_bound + 1).select(F.col("id").alias("generated_number"))


def intervals_between(part: str, start: Column, end: Column) -> Column:
    """Whole `part`s from start to end."""
    return F.timestamp_diff(part.upper(), start.cast("timestamp"), end.cast("timestamp"))


CHUNK = 10_000  # moments that one row of a spine unfolds into


def date_spine(bounds: DataFrame, part: str, start: str = "start", end: str = "end") -> DataFrame:
    """One row per `part` from start up to, not including, end; `bounds` has one row per wanted spine.

    A spine is first cut into chunks, which are dealt out; each makes its own moments, so a long spine is no single
    array in a single task.
    """
    if part not in PARTS:
        raise ValueError(f"part must be one of {PARTS}")
    name, unit = f"date_{part}", part.upper()
    steps = intervals_between(part, F.col(start), F.col(end))
    spines = bounds.select(F.col(start).cast("timestamp").alias("begin"), steps.alias("n")).filter("n > 0")
    chunks = spines.select("begin", "n", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / CHUNK))).alias("c"))
    chunks = chunks.repartition("begin", "c").withColumn("first", F.col("c") * CHUNK)
    last = F.least(F.col("first") + CHUNK, F.col("n")) - 1
    numbered = chunks.select("begin", F.explode(F.sequence(F.col("first"), last)).alias("i"))
    spine = numbered.select(F.timestamp_add(unit, F.col("i").cast("int"), F.col("begin")).alias(name))
    return spine.withColumn(name, F.to_date(name)) if part in ("day", "week", "month", "quarter", "year") else spine
