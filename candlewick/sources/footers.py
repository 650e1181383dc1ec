"""Parquet footers as a table: what files hold, without reading a data page."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Executors get the reader itself, so they need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_COLUMNS = "file string, file_bytes long, row_group int, rows long, first long, last long, codec string, bytes long"


def _micros(value) -> int:
    stamp = pd.Timestamp(value)
    stamp = stamp.tz_localize("UTC") if stamp.tzinfo is None else stamp
    return (stamp - pd.Timestamp("1970-01-01", tz="UTC")) // pd.Timedelta(microseconds=1)


def _reader(time: str, part: str) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """(path, length, part) of files -> one row for each row group, from its footer."""
    names = [*(c.split()[0] for c in _COLUMNS.split(", ")), part]

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import pyarrow.parquet as pq
        from pyarrow import fs

        for batch in batches:
            rows = []
            for path, length, of in batch[["path", "length", part]].itertuples(index=False):
                system, place = fs.FileSystem.from_uri(path)
                with system.open_input_file(place) as source:
                    footer = pq.ParquetFile(source).metadata
                at = [footer.schema.column(i).path for i in range(footer.num_columns)].index(time)
                for g in range(footer.num_row_groups):
                    group = footer.row_group(g)
                    column = group.column(at)
                    plain = column.is_stats_set and column.physical_type != "INT96"  # those have no order to compare by
                    known = column.statistics if plain and column.statistics.has_min_max else None
                    ends = (_micros(known.min), _micros(known.max)) if known else (None, None)
                    size = sum(group.column(i).total_compressed_size for i in range(group.num_columns))
                    rows.append((path, length, g, group.num_rows, *ends, column.compression, size, of))
            yield pd.DataFrame(rows, columns=names).astype({"first": "Int64", "last": "Int64"})

    return read


def row_groups(spark: SparkSession, path: str, time: str, part: str) -> DataFrame:
    """file, file_bytes, row_group, rows, first and last `time`, codec, compressed bytes, and the day folder `part`.

    Files are listed by Spark and their footers read in tasks. A row group whose writer left out the range of `time` (as
    for the old 96-bit times) has none here.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path).select("path", "length", part)
    count = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    found = files.repartition(count).mapInPandas(_reader(time, part), f"{_COLUMNS}, {part} date")
    return found.withColumns({c: F.timestamp_micros(c) for c in ("first", "last")})
