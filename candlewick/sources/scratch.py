"""Working folders that every executor can reach.

The cluster names its shared folder in `spark.checkpoint.dir`; intermediate tables, staged partitions and streaming
checkpoints go below it, so a lost executor or a restarted driver finds them again.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
_PASSING: list[list[str]] = []  # folders written inside the open `passing` blocks of this driver
_LOCAL_FOLDERS: dict[str, str] = {}  # local sessions without the setting, by application


def shared_folder(spark: SparkSession) -> str:
    folder = spark.conf.get(_SETTING, None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError(f"{_SETTING} must name a folder that all executors can reach")
    if context.applicationId not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[context.applicationId] = tempfile.mkdtemp(prefix="candlewick-")
    return _LOCAL_FOLDERS[context.applicationId]


def new_folder(spark: SparkSession, label: str) -> str:
    """Path of a folder that does not exist yet."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def delete(spark: SparkSession, path: str) -> None:
    """Delete a file or folder on any file system that Spark knows; nothing happens if there is none."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder that `new_folder` named, once nothing reads it any more."""
    if not path.startswith(f"{shared_folder(spark)}/"):
        raise ValueError(f"{path} is no working folder")
    delete(spark, path)


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write once, read back: cuts the lineage where a result is used several times."""
    spark, path = df.sparkSession, new_folder(df.sparkSession, label)
    df.write.parquet(path)
    if _PASSING:
        _PASSING[-1].append(path)
    return written_at(spark.read.schema(df.schema).parquet(path), path)


def written_at(df: DataFrame, path: str | None) -> DataFrame:
    """Note the working folder that `df` reads."""
    df._working_folder = path
    return df


def folder_of(df: DataFrame) -> str | None:
    """The working folder that `materialise` wrote for this very DataFrame."""
    return getattr(df, "_working_folder", None)


def discard(df: DataFrame) -> None:
    """Delete what `materialise` wrote for `df`, once nothing reads it any more."""
    if path := folder_of(df):
        remove_folder(df.sparkSession, path)


@contextmanager
def passing(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Deletes at its end what was materialised inside, but for the tables given to the function that it yields.

    Whatever is read after the block must have been given to it.
    """
    kept: set[str | None] = set()

    def keep(df: DataFrame) -> DataFrame:
        kept.add(folder_of(df))
        return df

    _PASSING.append([])
    try:
        yield keep
    finally:
        written = _PASSING.pop()
        for path in written:
            if path in kept:
                if _PASSING:  # of the block around this one
                    _PASSING[-1].append(path)
            else:
                remove_folder(spark, path)
