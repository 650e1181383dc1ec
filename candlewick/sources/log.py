"""The append-only tick log: one folder per day, clustered by symbol inside each file.

Times are written as plain microseconds, so a bound on `time` is compared with the footers' ranges and passes over row
groups, and `day_inventory` can tell what a log holds from the footers alone.
"""

from __future__ import annotations

import datetime as dt
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.functions.times import as_of_column
from candlewick.schema import DEFAULT_EXCHANGE, MAX_LENGTH, REQUIRED, TICK_LOG, check_same_columns
from candlewick.session import setting
from candlewick.sources.footers import row_groups
from candlewick.sources.scratch import delete

DAY = "dt"
MARKER = "_compacted"  # readers skip names that start with an underscore
WRITING, SWAP, OLD = "_writing-", "_swap-", "_old-"


def to_log_rows(ticks: DataFrame, received_at=None) -> DataFrame:
    """Apply the log's defaults, types and NOT NULL rules; rows breaking a rule are left out (see `broken_rows`)."""
    filled = ticks
    if "inserted_at" not in ticks.columns:
        filled = filled.withColumn("inserted_at", as_of_column(received_at))
    filled = filled.withColumn("inserted_at", F.coalesce("inserted_at", as_of_column(received_at)))
    filled = filled.withColumn("exchange", F.coalesce("exchange", F.lit(DEFAULT_EXCHANGE)))
    typed = filled.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in TICK_LOG])
    return typed.na.drop(subset=list(REQUIRED)).filter(~reduce(Column.__or__, _too_long().values()))


def _too_long() -> dict[str, Column]:
    return {c: F.coalesce(F.length(c) > most, F.lit(False)) for c, most in MAX_LENGTH.items()}


def broken_rows(ticks: DataFrame) -> DataFrame:
    """Rows the log refuses, with the names of the required columns that are empty and of those that are too long."""

    def names(wrong: dict[str, Column]) -> Column:
        return F.concat_ws(",", *[F.when(condition, F.lit(c)) for c, condition in wrong.items()])

    marked = ticks.withColumns({"missing": names({c: F.col(c).isNull() for c in REQUIRED}), "too_long": names(_too_long())})
    return marked.filter((F.col("missing") != "") | (F.col("too_long") != ""))


def _plain_times(spark: SparkSession):
    return setting(spark, spark__sql__parquet__outputTimestampType="TIMESTAMP_MICROS")


def _clustered(rows: DataFrame) -> DataFrame:
    """One folder per day, files of the advisory size: REBALANCE splits a heavy day and merges light ones at run time."""
    with_day = rows if DAY in rows.columns else rows.withColumn(DAY, F.to_date("time"))
    return with_day.hint("rebalance", DAY).sortWithinPartitions(DAY, "symbol", "exchange", F.desc("time"))


def append_log(rows: DataFrame, path: str) -> None:
    """Insert only: existing files are never touched."""
    with _plain_times(rows.sparkSession):
        _clustered(rows).write.mode("append").partitionBy(DAY).parquet(path)


def read_log(spark: SparkSession, path: str, schema=TICK_LOG) -> DataFrame:
    return spark.read.schema(T.StructType([*schema.fields, T.StructField(DAY, T.DateType())])).parquet(path)


def between(log: DataFrame, start=None, end=None) -> DataFrame:
    """Time range of a log; the day predicate prunes folders, the time predicate reaches the row groups."""
    if start is not None:
        begin = F.lit(start).cast("timestamp")
        log = on_days(log.filter(F.col("time") >= begin), begin)
    if end is not None:
        stop = F.lit(end).cast("timestamp")
        log = on_days(log.filter(F.col("time") <= stop), None, stop)
    return log


def on_days(ticks: DataFrame, first: Column | None = None, last: Column | None = None) -> DataFrame:
    """The day bounds that go with a bound on `time`, for ticks that still carry their day; folders are pruned by them."""
    if DAY in ticks.columns:
        if first is not None:
            ticks = ticks.filter(F.col(DAY) >= F.to_date(first))
        if last is not None:
            ticks = ticks.filter(F.col(DAY) <= F.to_date(last))
    return ticks


def replace_days(rows: DataFrame, path: str) -> None:
    """Swap exactly the day folders present in `rows`, which are written once, as they come.

    The new folders are written beside the days, on the same store, while the plan may still read the old ones. A rename
    marks them as whole; `finish_swaps` then moves each old folder aside and the new one into its place, and may be
    repeated from wherever a run died. Between the two moves of a day readers miss it; one writer at a time.
    """
    spark, name = rows.sparkSession, uuid.uuid4().hex
    finish_swaps(spark, path)
    writing = f"{path}/{WRITING}{name}"
    try:
        with _plain_times(spark):
            rows.write.partitionBy(DAY).parquet(writing)
        _rename(spark, writing, f"{path}/{SWAP}{name}")
    except Exception:
        delete(spark, writing)
        raise
    finish_swaps(spark, path)


def finish_swaps(spark: SparkSession, path: str) -> list[str]:
    """Put the day folders of whole swaps into place; returns the days that were moved."""
    moved = []
    root, fs = _file_system(spark, path)
    if not fs.exists(root):
        return moved
    for swap in sorted(n for n in _names(spark, path) if n.startswith(SWAP)):
        for day in sorted(n for n in _names(spark, f"{path}/{swap}") if n.startswith(f"{DAY}=")):
            if path_exists(spark, f"{path}/{day}"):  # what is there is old as long as the new one waits here
                _rename(spark, f"{path}/{day}", f"{path}/{swap}/{OLD}{day}")
            _rename(spark, f"{path}/{swap}/{day}", f"{path}/{day}")
            moved.append(day)
        delete(spark, f"{path}/{swap}")
    return moved


def _names(spark: SparkSession, path: str) -> list[str]:
    root, fs = _file_system(spark, path)
    return [status.getPath().getName() for status in fs.listStatus(root)]


def _rename(spark: SparkSession, source: str, target: str) -> None:
    root, fs = _file_system(spark, source)
    goal, _ = _file_system(spark, target)
    if not fs.rename(root, goal):
        raise OSError(f"{source} could not be renamed to {target}")


def _file_system(spark: SparkSession, path: str):
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return root, root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def day_folders(spark: SparkSession, path: str) -> dict[dt.date, str]:
    """Day -> folder, from the folder names alone."""
    root, fs = _file_system(spark, path)
    names = [status.getPath().getName() for status in fs.listStatus(root)]
    return {dt.date.fromisoformat(n[len(DAY) + 1 :]): f"{path}/{n}" for n in names if n.startswith(f"{DAY}=")}


def compacted_days(spark: SparkSession, path: str) -> list[dt.date]:
    """Days that carry a marker and have got no file since."""
    done = []
    for day, folder in sorted(day_folders(spark, path).items()):
        root, fs = _file_system(spark, folder)
        age = {s.getPath().getName(): s.getModificationTime() for s in fs.listStatus(root)}
        marked = age.pop(MARKER, None)
        if marked is not None and all(t <= marked for t in age.values()):
            done.append(day)
    return done


def compact_log(spark: SparkSession, path: str, as_of: dt.datetime, older_than_days: int = 3) -> list[dt.date]:
    """Rewrite the days past the age limit into few clustered files; rows stay the same.

    A finished day is marked and left alone until new files arrive, so a run costs no more than what has changed.
    Returns the rewritten days.
    """
    limit, done = as_of.date() - dt.timedelta(days=older_than_days), set(compacted_days(spark, path))
    days = [d for d in sorted(day_folders(spark, path)) if d < limit and d not in done]
    if days:
        replace_days(_clustered(spark.read.parquet(path).filter(F.col(DAY).isin(days))), path)
    for day in days:
        marker, fs = _file_system(spark, f"{path}/{DAY}={day}/{MARKER}")
        fs.create(marker, True).close()
    return days


def live_rows(log: DataFrame, as_of: dt.datetime, keep_days: int = 90) -> DataFrame:
    """The log as retention leaves it."""
    return log.filter(F.col(DAY) >= F.lit(as_of.date() - dt.timedelta(days=keep_days)))


def expire_days(spark: SparkSession, path: str, as_of: dt.datetime, keep_days: int = 90) -> list[str]:
    """Delete the day folders past retention; returns their names."""
    oldest = as_of.date() - dt.timedelta(days=keep_days)
    expired = {day: folder for day, folder in day_folders(spark, path).items() if day < oldest}
    for folder in expired.values():
        root, fs = _file_system(spark, folder)
        fs.delete(root, True)
    return [f"{DAY}={day}" for day in sorted(expired)]


def drop_files(spark: SparkSession, path: str, files: list[tuple[dt.date, str]]) -> list[str]:
    """Delete the named files of (day, name) and the day folders that are left without data; returns those days."""
    gone = []
    for day, name in files:
        target, fs = _file_system(spark, f"{path}/{DAY}={day}/{name}")
        fs.delete(target, False)
    for day in sorted({day for day, _ in files}):
        folder, fs = _file_system(spark, f"{path}/{DAY}={day}")
        if all(s.getPath().getName().startswith(("_", ".")) for s in fs.listStatus(folder)):
            fs.delete(folder, True)
            gone.append(f"{DAY}={day}")
    return gone


def day_inventory(spark: SparkSession, path: str) -> DataFrame:
    """Per day: time range, rows, files, bytes and state, from the footers; `time` is read only in files without ranges."""
    groups = row_groups(spark, path, "time", DAY)
    files = groups.groupBy(DAY, "file").agg(
        F.min("first").alias("first"), F.max("last").alias("last"), F.sum("rows").alias("n"),
        F.max("file_bytes").alias("size"), F.count("*").alias("groups"),
        F.count_if(F.col("first").isNull() & (F.col("rows") > 0)).alias("unknown"),
    )
    if not files.filter("unknown > 0").isEmpty():
        # a task gives the files of all its days one name
        read = spark.read.parquet(path).groupBy(DAY, F.element_at(F.split("_metadata.file_path", "/"), -1).alias("_name"))
        read = read.agg(F.min("time").alias("_first"), F.max("time").alias("_last"))
        named = files.withColumn("_name", F.element_at(F.split("file", "/"), -1)).join(read, [DAY, "_name"], "left")
        files = named.withColumns({"first": F.coalesce("_first", "first"), "last": F.coalesce("_last", "last")})
    return files.groupBy(DAY).agg(
        F.min("first").alias("range_start"),
        F.max("last").alias("range_end"),
        F.sum("n").alias("row_count"),
        F.count("*").alias("file_count"),
        F.sum("size").alias("total_bytes"),
        F.sum("groups").alias("row_groups"),
    ).withColumn("is_compacted", F.col(DAY).isin(compacted_days(spark, path)))


def write_table(df: DataFrame, path: str, partition: str | None = None) -> None:
    """Full refresh of a table."""
    writer = df.write.mode("overwrite")
    with _plain_times(df.sparkSession):
        (writer.partitionBy(partition) if partition else writer).parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    target, fs = _file_system(spark, path)
    return fs.exists(target)


def upsert(batch: DataFrame, path: str, keys: list[str], full_refresh: bool = False) -> None:
    """Insert new keys and replace existing ones in a day-partitioned table.

    A key must not move between days (windowed models derive both from the window start). Only the days the batch
    touches are read and rewritten.
    """
    spark = batch.sparkSession
    finish_swaps(spark, path)
    if full_refresh or not path_exists(spark, path):
        with _plain_times(spark):
            batch.hint("rebalance", DAY).sortWithinPartitions(DAY).write.mode("overwrite").partitionBy(DAY).parquet(path)
        return
    if day_folders(spark, path):  # a table without any day has no columns yet
        check_same_columns(batch.schema, spark.read.parquet(path).schema)
    fresh = batch.persist()  # used three times below; what is lost with an executor is computed again
    try:
        # Distinct days of one incremental batch: bounded by the lookback, not by the number of rows.
        days = [row[0] for row in fresh.select(DAY).distinct().collect()]
        target = spark.read.schema(batch.schema).parquet(path).filter(F.col(DAY).isin(days)).alias("old")
        same = [F.col(f"old.{k}").eqNullSafe(F.col(f"new.{k}")) for k in keys]
        kept = target.join(fresh.select(*keys).alias("new"), same, "left_anti")
        if days:
            merged = kept.select(*batch.columns).unionByName(fresh)
            replace_days(merged.hint("rebalance", DAY).sortWithinPartitions(DAY, *[k for k in keys if k != DAY]), path)
    finally:
        fresh.unpersist()
