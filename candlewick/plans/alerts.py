"""Sliding-window price alerts, batch form."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewick.functions.times import micros
from candlewick.operators.ordered import SLICE, with_slices

# Window and limit in percent.
WINDOW, THRESHOLD = "5 minutes", 10.0


def slice_start(us: Column, span: int) -> Column:
    return us - F.pmod(us, F.lit(span))


def oldest_in_window(ticks: DataFrame, window: str = WINDOW, slices: int | None = None) -> DataFrame:
    """Each tick with `old_price`: the price of the first tick (time, id) not older than `window`.

    A RANGE frame would re-read its whole frame for every row. Instead each tick also asks a question at `time -
    window`, and the next tick in order is the answer: scanning backwards, one running value. Ticks and questions are
    cut into slices of about equal size by range partitioning, whatever symbol or moment they crowd at; a question
    without a tick after it in its slice takes the first tick of its symbol in a later slice.
    """
    us = F.unix_micros("time")
    tick = F.struct(us.alias("at"), F.lit(0).alias("ask"))
    question = F.struct((us - micros(window)).alias("at"), F.lit(1).alias("ask"))
    both = ticks.select("symbol", "id", "price", F.explode(F.array(tick, question)).alias("e"))
    rows = both.select("symbol", "id", "price", "e.*").filter("symbol IS NOT NULL")
    rows = with_slices(rows, ["symbol", "at", F.desc("ask"), "id"], slices)

    passed = F.when(F.col("ask") == 0, F.col("price"))
    moment = F.col("at").cast("decimal(18,0)") * F.lit(Decimal(10**20)).cast("decimal(21,0)") + F.col("id").cast("decimal(20,0)")
    heads = rows.groupBy("symbol", SLICE).agg(F.min_by(passed, F.when(F.col("ask") == 0, moment)).alias("head"))
    later = Window.partitionBy("symbol").orderBy(SLICE).rowsBetween(1, Window.unboundedFollowing)  # a row per slice
    next_heads = heads.select("symbol", SLICE, F.first("head", ignorenulls=True).over(later).alias("next_head"))
    backwards = (
        Window.partitionBy("symbol", SLICE)
        .orderBy(F.desc("at"), F.asc("ask"), F.desc("id"))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    answered = rows.withColumn("old_price", F.last(passed, ignorenulls=True).over(backwards)).filter("ask = 1")
    old = F.coalesce("old_price", "next_head").alias("old_price")
    time = F.timestamp_micros(F.col("at") + micros(window)).alias("time")
    return answered.join(next_heads, ["symbol", SLICE]).select("symbol", time, "id", old, F.col("price").alias("new_price"))


def alert_message(window: str = WINDOW) -> Column:
    # Fixed value: the text of an alert.
    minutes = micros(window) // 60_000_000
    return F.format_string(
        f"ALERT: %s price changed by %.2f%% in last {minutes} minutes (%s -> %s)",
        F.col("symbol"),
        F.bround("price_change_pct", 2),  # ties to even, as %.2f does elsewhere
        F.col("old_price").cast("string"),
        F.col("new_price").cast("string"),
    )


def with_change(compared: DataFrame) -> DataFrame:
    old, new = F.col("old_price").cast("double"), F.col("new_price").cast("double")
    return compared.withColumn("price_change_pct", (new - old) / old * 100)


def price_alerts(ticks: DataFrame, window: str = WINDOW, threshold: float = THRESHOLD) -> DataFrame:
    """Ticks whose price moved by more than `threshold` percent against the oldest price of the window.

    Every such tick alerts; a tick alone in its window compares with itself and stays silent.
    """
    changed = with_change(oldest_in_window(ticks, window))
    return changed.filter(F.abs("price_change_pct") > threshold).withColumn("message", alert_message(window))


def alert_levels(ticks: DataFrame, levels: tuple[float, ...], window: str = WINDOW) -> DataFrame:
    """Alerts and symbols' counts for several thresholds, from one pass over the ticks."""
    changed = with_change(oldest_in_window(ticks, window))
    level = F.explode(F.array(*[F.lit(float(x)) for x in levels])).alias("level")
    return (
        changed.select("symbol", F.abs("price_change_pct").alias("moved"), level)
        .filter(F.col("moved") > F.col("level"))
        .groupBy("symbol", "level")
        .agg(F.count("*").alias("alerts"), F.max("moved").alias("largest_move_pct"))
    )
