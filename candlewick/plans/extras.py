"""Extensions: named in design notes only, so kept apart from the models."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.functions.numbers import change_pct, safe_divide
from candlewick.functions.times import arrival_order, bucket_start, micros
from candlewick.operators.joins import side_by_side
from candlewick.operators.ordered import in_steps, over_last_rows
from candlewick.plans.candles import WIDTH, ohlc
from candlewick.plans.monitor import data_gaps
from candlewick.schema import TICK_LOG
from candlewick.sources.log import DAY, drop_files, read_log, upsert


def vwap(ticks: DataFrame, width: str = WIDTH) -> DataFrame:
    """Volume-weighted average price per symbol and window."""
    price, volume = F.col("price").cast("double"), F.col("volume").cast("double")
    grouped = ticks.groupBy("symbol", bucket_start("time", width).alias("window_start")).agg(
        F.sum(price * volume).alias("turnover"), F.sum(volume).alias("total_volume")
    )
    return grouped.select("symbol", "window_start", safe_divide("turnover", "total_volume").alias("vwap"), "total_volume")


def _over_candles(base: DataFrame, rows: int, columns: dict, width: str) -> DataFrame:
    """Columns over the last candles of a symbol; a slice holds a fixed number of periods, so no symbol is one task."""
    by = in_steps("period_start", micros(width))
    return over_last_rows(base, ["symbol"], ["period_start"], rows, columns, by=by)


def momentum(base: DataFrame, periods: int = 4, width: str = WIDTH) -> DataFrame:
    """Change of the close against `periods` candles before; `width` is that of the candles."""
    closes = base.select("symbol", "period_start", "close")
    held = _over_candles(closes, periods, {"earlier": lambda w: F.lag("close", periods).over(w)}, width)
    earlier = F.col("earlier")
    return held.select(
        "symbol",
        "period_start",
        "close",
        (F.col("close") - earlier).alias("momentum"),
        change_pct(F.col("close"), earlier).alias("momentum_pct"),
    )


def rsi(base: DataFrame, periods: int = 14, width: str = WIDTH) -> DataFrame:
    """Relative strength index from simple averages of gains and losses; NULL until `periods` changes are known."""
    closes = base.select("symbol", "period_start", F.col("close").alias("close"))
    held = _over_candles(closes, periods, {"closes": lambda w: F.collect_list("close").over(w.rowsBetween(-periods, 0))}, width)
    steps = F.transform(
        F.sequence(F.lit(2), F.size("closes")), lambda i: (F.element_at("closes", i) - F.element_at("closes", i - 1)).cast("double")
    )
    known = F.size("closes") - 1
    stepped = held.select("symbol", "period_start", F.when(known == periods, steps).alias("steps"))
    total = lambda sign: F.aggregate("steps", F.lit(0.0), lambda a, x: a + F.greatest(x * sign, F.lit(0.0)))
    summed = stepped.select("symbol", "period_start", total(1.0).alias("gain"), total(-1.0).alias("loss"))
    strength = F.col("gain") / F.nullif(F.col("gain") + F.col("loss"), F.lit(0.0)) * 100
    return summed.select("symbol", "period_start", strength.alias("rsi"))


def clean_ticks(ticks: DataFrame) -> DataFrame:
    """Standard symbols, no negative volume, one tick per symbol and instant (the first by id)."""
    named = ticks.withColumn("symbol", F.upper(F.trim("symbol"))).filter(F.col("volume") >= 0)
    first = F.min_by(F.struct(*named.columns), "id")
    return named.groupBy("symbol", "time").agg(first.alias("t")).select("t.*")


def quality_kpis(ticks: DataFrame, max_gap_seconds: int = 60) -> DataFrame:
    """Shares of incomplete, repeated and impossible ticks and of pauses, in percent of all ticks."""
    incomplete = F.col("price").isNull() | F.col("volume").isNull()
    impossible = (F.col("price") <= 0) | (F.col("volume") < 0)
    per_key = ticks.groupBy("symbol", "time").agg(
        F.count("*").alias("n"), F.count_if(incomplete).alias("incomplete"), F.count_if(impossible).alias("impossible")
    )
    totals = per_key.agg(
        F.sum("n").alias("ticks"),
        F.sum("incomplete").alias("incomplete"),
        F.sum(F.col("n") - 1).alias("repeated"),
        F.sum("impossible").alias("impossible"),
    )
    gaps = data_gaps(ticks, max_gap_seconds).agg(F.count("*").alias("gaps"))

    def rate(column: str):
        return (safe_divide(F.col(column), "ticks") * 100).alias(f"{column}_pct")

    return side_by_side(totals, gaps).select(
        "ticks", rate("incomplete"), rate("repeated"), rate("impossible"), rate("gaps")
    )


def downsample_then_expire(
    spark: SparkSession, log_path: str, summary_path: str, as_of: dt.datetime, keep_days: int, width: str = "1 hour"
) -> list[str]:
    """Write candles of the days about to expire, compare their totals with the log, then drop the files they came from.

    The summary holds a part of a candle for every log file: a repeated run replaces the parts of files that are still
    there, ticks that came late add parts of their own, and a file that arrives meanwhile is left for the next run.
    `downsampled` folds the parts. Returns the days that are gone from the log.
    """
    oldest = F.lit(as_of.date() - dt.timedelta(days=keep_days))
    expiring = read_log(spark, log_path).filter(F.col(DAY) < oldest)
    expiring = expiring.select(DAY, F.col("_metadata.file_name").alias("part"), *TICK_LOG.names)
    files = [(row[DAY], row["part"]) for row in expiring.select(DAY, "part").distinct().collect()]  # of the expired days
    if not files:
        return []
    order = arrival_order()
    parts = expiring.groupBy(DAY, "part", bucket_start("time", width).alias("period_start"), "symbol").agg(
        *ohlc(),
        F.sum("volume").alias("total_volume"),
        F.count("*").alias("trade_count"),
        F.min(order).alias("first_at"),
        F.max(order).alias("last_at"),
    )
    upsert(parts, summary_path, [DAY, "part", "period_start", "symbol"])
    stored = spark.read.parquet(summary_path).groupBy(DAY, "part").agg(
        F.sum("trade_count").alias("stored_ticks"), F.sum("total_volume").alias("stored_volume")
    )
    logged = expiring.groupBy(DAY, "part").agg(F.count("*").alias("ticks"), F.sum("volume").alias("volume"))
    equal = F.col("ticks").eqNullSafe(F.col("stored_ticks")) & F.col("volume").eqNullSafe(F.col("stored_volume"))
    wrong = logged.join(stored, [DAY, "part"], "left").filter(~F.coalesce(equal, F.lit(False))).first()
    if wrong is not None:
        raise RuntimeError(f"the summary of {wrong[DAY]} does not match the log; nothing was dropped")
    return drop_files(spark, log_path, files)


def downsampled(spark: SparkSession, summary_path: str) -> DataFrame:
    """The candles of a summary, each folded from its parts."""
    return spark.read.parquet(summary_path).groupBy(DAY, "period_start", "symbol").agg(
        F.min_by("open", "first_at").alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max_by("close", "last_at").alias("close"),
        F.sum("total_volume").alias("total_volume"),
        F.sum("trade_count").alias("trade_count"),
    )
