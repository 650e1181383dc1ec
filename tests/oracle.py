"""Runs a registered query and its SQL side by side."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 6) + 0.0)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, (list, tuple)):
        return str([plain(v) for v in value])
    return str(value)


def normalised(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(plain(r[i]) for i in order) for r in rows)


def compare(spark_df, con, sql: str) -> str | None:
    """None when equal, else a short description of the difference."""
    cursor = con.execute(sql)
    want_cols, want = normalised([d[0] for d in cursor.description], cursor.fetchall())
    have_cols, have = normalised(spark_df.columns, spark_df.collect())
    if have_cols != want_cols:
        return f"columns {have_cols} != {want_cols}"
    if len(have) != len(want):
        return f"{len(have)} rows, expected {len(want)}"
    wrong = [(h, w) for h, w in zip(have, want) if h != w]
    return f"{len(wrong)} of {len(want)} rows differ, first {wrong[0]}" if wrong else None
