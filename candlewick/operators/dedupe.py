"""One row per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def deduplicate(df: DataFrame, partition_by: list[str], order_by: list[Column | str]) -> DataFrame:
    """The first row per key in the given order, all columns kept; NULL keys form a group of their own.

    `row_number() = 1` lets Spark put a group limit before the shuffle: each task sends one row per key, so a key
    with a large part of the table does not overload one task.
    """
    in_order = Window.partitionBy(*partition_by).orderBy(*order_by)
    return df.withColumn("_rank", F.row_number().over(in_order)).filter("_rank = 1").drop("_rank")
