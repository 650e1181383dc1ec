"""URL parts. Plain text rules, so input without a scheme works too (parse_url would return NULL)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _without(url: Column | str, schemes: tuple[str, ...]) -> Column:
    start = F.col(url) if isinstance(url, str) else url
    return reduce(lambda text, scheme: F.replace(text, F.lit(scheme), F.lit("")), schemes, start)


def _before(text: Column, mark: str) -> Column:
    return F.split_part(text, F.lit(mark), F.lit(1))


def url_host(url: Column | str) -> Column:
    return _before(_before(_without(url, ("android-app://", "http://", "https://")), "/"), "?")


def url_path(url: Column | str) -> Column:
    """Everything after the first '/' (or after the host, when only a query follows) and before '?'."""
    bare = _without(url, ("http://", "https://"))
    slash = F.locate("/", bare)
    cut = F.when(slash > 0, slash).otherwise(F.locate("?", bare) - 1)
    return _before(F.right(bare, F.length(bare) - cut), "?")


def url_parameter(url: Column | str, name: str) -> Column:
    """Value after the first 'name=' up to '&'; NULL when absent or empty."""
    start = F.col(url) if isinstance(url, str) else url
    return F.nullif(_before(F.split_part(start, F.lit(f"{name}="), F.lit(2)), "&"), F.lit(""))
