"""Keys, slugs and blank handling."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: stands for NULL inside a surrogate key, so that stored keys stay comparable.
NULL_KEY_TOKEN = "_dbt_utils_surrogate_key_null_"


def surrogate_key(*columns: Column | str, null_as_empty: bool = False) -> Column:
    """md5 over the columns as text, joined by '-'."""
    token = F.lit("" if null_as_empty else NULL_KEY_TOKEN)
    parts = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), token) for c in columns]
    return F.md5(F.concat_ws("-", *parts))


def period_key(start: Column | str, *keys: Column | str) -> Column:
    """md5 of 'start|key…' with a fixed time format: the merge key of windowed models."""
    return F.md5(F.concat_ws("|", F.date_format(start, "yyyy-MM-dd HH:mm:ss"), *keys))


def blank_to_null(column: Column | str) -> Column:
    return F.nullif(F.col(column) if isinstance(column, str) else column, F.lit(""))


def slug(column: Column | str) -> Column:
    """Lower-case identifier of a text; '' for NULL."""
    lowered = F.lower(F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit("")))
    words = F.regexp_replace(F.regexp_replace(lowered, "[ -]+", "_"), "[^a-z0-9_]+", "")
    return F.regexp_replace(words, "^([0-9])", "_$1")


def slug_name(text: str | None) -> str:
    """The same rule for a column alias built on the driver."""
    words = re.sub("[^a-z0-9_]+", "", re.sub("[ -]+", "_", (text or "").lower()))
    return f"_{words}" if words[:1].isdigit() else words
