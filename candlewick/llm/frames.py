"""Columns of a DataFrame whatever their names are."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame


def column(df: DataFrame, name: str) -> Column:
    return df[f"`{name}`"]


def every(df: DataFrame) -> list[Column]:
    return [column(df, c) for c in df.columns]
