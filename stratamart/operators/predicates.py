"""Filters and sorts chosen by the caller."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.casts import utc_instant


def contains_ignoring_case(c: Column, needle: str) -> Column:
    return F.coalesce(F.lower(c).contains(needle.lower()), F.lit(False))


def search(df: DataFrame, text: str | None, *columns: str) -> DataFrame:
    """Rows where any of the columns contains the text; everything when the text is empty."""
    if not text:
        return df
    return df.where(reduce(lambda a, b: a | b, [contains_ignoring_case(F.col(c), text) for c in columns]))


def any_element_contains(array_column: str, field: str, text: str) -> Column:
    """True if some struct of the array has the text in ``field``."""
    return F.exists(array_column, lambda o: contains_ignoring_case(o[field], text))


def within_days(ts: Column, as_of: dt.datetime | Column, days: int) -> Column:
    """Strictly after ``as_of`` minus the given days."""
    return ts > F.timestamp_add("DAY", F.lit(-days), utc_instant(as_of))


def quality_filter(df: DataFrame, choice: str = "all") -> DataFrame:
    """``issues``: any null or under 50 % distinct; ``nulls``: any null; else all."""
    if choice == "issues":
        return df.where((F.col("null_pct") > 0) | (F.col("distinct_pct") < 50))
    if choice == "nulls":
        return df.where(F.col("null_pct") > 0)
    return df


def sorted_by(df: DataFrame, key: str, direction: str = "asc") -> DataFrame:
    """Sort by a column picked at run time; text compares without case."""
    c = F.col(key)
    if isinstance(df.schema[key].dataType, T.StringType):
        c = F.lower(F.coalesce(c, F.lit("")))
    return df.orderBy(c.desc() if direction == "desc" else c.asc())
