"""A message log with positions: what a broker topic is, as a table.

A log is a folder. Every append writes its messages as Parquet segments below a folder of its own, in slices of equal
size by (topic, partition, offset), and commits them by one file in `index/` that lists what each segment holds: topic,
partition, first and last offset and number of rows. Readers see committed segments only, so an append that died half-way
is invisible, and may be repeated with the same `name`: of two commits of one name the first counts.

Offsets of a partition must ascend from append to append; they may have gaps.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.schema import MESSAGES
from candlewick.sources.log import path_exists

PLACE = ["topic", "partition"]
SEGMENTS = T.StructType(
    [
        T.StructField("append", T.StringType()),
        T.StructField("file", T.StringType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("first", T.LongType()),
        T.StructField("last", T.LongType()),
        T.StructField("rows", T.LongType()),
    ]
)


def append_messages(messages: DataFrame, path: str, name: str | None = None, slices: int | None = None) -> bool:
    """Add messages as one append; False, and nothing is added, if `name` is committed already.

    A busy partition is cut into several segments, so no task writes a whole one.
    """
    spark = messages.sparkSession
    name = name or uuid.uuid4().hex
    if name in {r[0] for r in segments(spark, path).select("append").distinct().collect()}:  # one row for each append
        return False
    folder = f"segments/{uuid.uuid4().hex}"
    count = slices or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = messages.select(*[F.col(f.name).cast(f.dataType) for f in MESSAGES])
    dealt = rows.repartitionByRange(count, *PLACE, "offset").sortWithinPartitions(*PLACE, "offset")
    dealt.write.parquet(f"{path}/{folder}")
    written = spark.read.schema(MESSAGES).parquet(f"{path}/{folder}")
    found = written.groupBy("_metadata.file_name", *PLACE).agg(
        F.min("offset").alias("first"), F.max("offset").alias("last"), F.count("*").alias("rows")
    )
    file = F.concat(F.lit(f"{folder}/"), "file_name").alias("file")  # from the log's own folder on: a log can be moved
    listed = found.select(F.lit(name).alias("append"), file, *PLACE, "first", "last", "rows")
    listed.coalesce(1).write.mode("append").parquet(f"{path}/index")  # one file: seen whole or not at all
    return True


def segments(spark: SparkSession, path: str) -> DataFrame:
    """The committed segments; of several commits of one append the first by file name."""
    if not path_exists(spark, f"{path}/index"):
        return spark.createDataFrame([], SEGMENTS)
    listed = spark.read.schema(SEGMENTS).parquet(f"{path}/index")
    folder = F.regexp_extract("file", "^segments/([^/]+)/", 1)
    marked = listed.withColumn("_folder", folder)
    first = marked.groupBy("append").agg(F.min("_folder").alias("_folder"))
    return marked.join(first, ["append", "_folder"], "left_semi").drop("_folder")


def ends(spark: SparkSession, path: str) -> DataFrame:
    """topic, partition, first offset held and the next offset to be written; from the index alone."""
    return segments(spark, path).groupBy(*PLACE).agg(
        F.min("first").alias("first_offset"), (F.max("last") + 1).alias("next_offset"), F.sum("rows").alias("messages")
    )


def read_messages(spark: SparkSession, path: str) -> DataFrame:
    """The whole log as a batch."""
    folder = F.concat(F.lit(f"{path}/"), F.regexp_extract("file", "^(segments/[^/]+)/", 1))
    folders = [r[0] for r in segments(spark, path).select(folder).distinct().collect()]  # one row for each append
    return spark.read.schema(MESSAGES).parquet(*folders) if folders else spark.createDataFrame([], MESSAGES)
