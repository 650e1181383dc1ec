"""Declared-schema CSV files, JSON reports and catalog lookups."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Header row, declared types, empty fields as NULL."""
    return spark.read.csv(path, header=True, schema=schema, mode="FAILFAST")


def write_report(df: DataFrame, path: str) -> None:
    """JSON lines; times keep their microseconds."""
    df.write.mode("overwrite").option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").json(path)


def _like(pattern: str) -> re.Pattern:
    """SQL LIKE, case-insensitive."""
    return re.compile("".join({"%": ".*", "_": "."}.get(ch, re.escape(ch)) for ch in pattern), re.IGNORECASE)


def tables_like(spark: SparkSession, pattern: str, exclude: str = "") -> list[str]:
    """Names of catalog tables and views that match a LIKE pattern, without those matching `exclude`."""
    wanted, unwanted = _like(pattern), _like(exclude) if exclude else None
    names = sorted({t.name for t in spark.catalog.listTables()})
    return [n for n in names if wanted.fullmatch(n) and not (unwanted and unwanted.fullmatch(n))]


def relations_like(spark: SparkSession, schema_pattern: str, pattern: str, exclude: str = "") -> list[tuple[str, str, str]]:
    """(schema, name, table type) of relations in all schemas that match, by LIKE patterns; the type is lower case.

    Temporary views have no schema and are listed by `tables_like`.
    """
    schemas, wanted, unwanted = _like(schema_pattern), _like(pattern), _like(exclude) if exclude else None
    found = []
    for schema in spark.catalog.listDatabases():
        if not schemas.fullmatch(schema.name):
            continue
        for table in spark.catalog.listTables(schema.name):
            if table.isTemporary or not wanted.fullmatch(table.name) or (unwanted and unwanted.fullmatch(table.name)):
                continue
            found.append((schema.name, table.name, "view" if table.tableType == "VIEW" else "table"))
    return sorted(found)


def tables_with_prefix(spark: SparkSession, prefix: str, exclude: str = "") -> list[str]:
    escaped = prefix.lower()
    return [n for n in tables_like(spark, "%", exclude) if n.lower().startswith(escaped)]
