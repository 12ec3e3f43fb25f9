"""Safe casts and exact decimal arithmetic.

ANSI mode makes plain casts raise, so every "safe" conversion is a ``try_``
function. NUMERIC is decimal(38,9); Spark drops scale when both operands are
that wide, so the arithmetic helpers narrow the integer part of the operands
first and never the fraction. Values beyond the narrowed range raise, they are
not rounded or nulled.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC = T.DecimalType(38, 9)

# Text formats of the raw layer, lenient on leading zeros. The plain
# casts parse these several times faster than a format string does but accept
# more; the patterns keep out what the formats do not allow.
DATE_FORMAT = r"^\d{4}-\d{1,2}-\d{1,2}$"
TIMESTAMP_FORMAT = r"^\d{4}-\d{1,2}-\d{1,2}T\d{1,2}:\d{1,2}:\d{1,2}$"


def safe_numeric(c: Column) -> Column:
    return c.try_cast(NUMERIC)


def safe_integer(c: Column) -> Column:
    return c.try_cast(T.LongType())


def parse_date(c: Column) -> Column:
    return F.when(c.rlike(DATE_FORMAT), c.try_cast(T.DateType()))


def parse_timestamp(c: Column) -> Column:
    return F.when(c.rlike(TIMESTAMP_FORMAT), c.try_cast(T.TimestampType()))


def utc_instant(value: dt.datetime | Column) -> Column:
    """A Python datetime as a literal; without a zone it is UTC, whatever the driver machine's zone."""
    if isinstance(value, Column):
        return value
    if value.tzinfo is not None:
        value = value.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def to_numeric(c: Column) -> Column:
    return c.cast(NUMERIC)


def subtract(a: Column, b: Column) -> Column:
    """a - b at scale 9: (37,9) - (37,9) is (38,9)."""
    narrow = T.DecimalType(37, 9)
    return a.cast(narrow) - b.cast(narrow)


def times(count: Column, amount: Column) -> Column:
    """integer * NUMERIC at scale 9: (16,0) * (21,9) is (38,9)."""
    return count.cast(T.DecimalType(16, 0)) * amount.cast(T.DecimalType(21, 9))


def ratio(a: Column, b: Column) -> Column:
    """NULL on a zero divisor; (26,9) / (26,9) is (38,12), rounded to 9 digits."""
    narrow = T.DecimalType(26, 9)
    return F.try_divide(a.cast(narrow), b.cast(narrow)).cast(NUMERIC)


def average_of(total: Column, n: Column) -> Column:
    """Mean from a sum and a count; (28,9) / (18,0) is (38,19), rounded to 9 digits."""
    return F.try_divide(total.cast(T.DecimalType(28, 9)), n.cast(T.DecimalType(18, 0))).cast(NUMERIC)


def plain_number_text(c: Column) -> Column:
    """NUMERIC as text without trailing zeros.

    Only for values with a fractional type: on a count, '100' would lose its zeros.
    """
    return F.regexp_replace(c.cast(NUMERIC).cast("string"), r"\.?0+$", "")
