"""Display formatting and small derived labels."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Size units, base 1024, smallest first.
BYTE_UNITS = ["B", "KB", "MB", "GB", "TB"]

# Layers in the order they are tested and shown.
LAYERS = ["raw", "staging", "analytics", "reporting"]

# Dataset suffix dropped from display labels.
DATASET_SUFFIX = "_ecommerce"

MISSING = "-"


def _trimmed(c: Column, scale: int) -> Column:
    """Fixed-scale text without trailing zeros."""
    return F.regexp_replace(c.cast(T.DecimalType(38, scale)).cast("string"), r"\.?0+$", "")


def preview(query: Column, width: int = 500) -> Column:
    return F.substring(F.coalesce(query, F.lit("")), 1, width)


def truncated(c: Column, width: int) -> Column:
    return (F.when(c.isNull() | (c == ""), MISSING)
            .when(F.length(c) > width, F.concat(F.substring(c, 1, width), F.lit("...")))
            .otherwise(c))


def email_local_part(c: Column) -> Column:
    return F.split_part(c, F.lit("@"), F.lit(1))


def human_bytes(c: Column) -> Column:
    """``1536`` -> ``1.5 KB``; sizes past the last unit stay in that unit."""
    n = F.coalesce(c.cast("double"), F.lit(0.0))
    out = F.when(n == 0, "0 B")
    for power in range(len(BYTE_UNITS) - 1, -1, -1):
        scaled = F.concat(_trimmed(F.round(n / F.lit(float(1024 ** power)), 2), 2),
                          F.lit(" " + BYTE_UNITS[power]))
        out = out.when(n >= float(1024 ** power), scaled) if power else out.otherwise(scaled)
    return out


def _elapsed_millis(start: Column, end: Column) -> Column:
    return (F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))) / 1000


def human_duration(start: Column, end: Column) -> Column:
    """Below a second in ms, below a minute in s, else in minutes; one decimal."""
    ms = F.floor(_elapsed_millis(start, end))
    one_decimal = T.DecimalType(20, 1)
    return (F.when(start.isNull() | end.isNull(), MISSING)
            .when(ms < 1000, F.concat(ms.cast("string"), F.lit("ms")))
            .when(ms < 60000, F.concat(F.round(ms / 1000, 1).cast(one_decimal).cast("string"), F.lit("s")))
            .otherwise(F.concat(F.round(ms / 60000, 1).cast(one_decimal).cast("string"), F.lit("m"))))


def human_date(c: Column) -> Column:
    return F.coalesce(F.date_format(c, "MMM d, yyyy"), F.lit(MISSING))


def human_datetime(c: Column) -> Column:
    return F.coalesce(F.date_format(c, "MMM d, yyyy, h:mm a"), F.lit(MISSING))


def iso_text(c: Column) -> Column:
    """ISO-8601 in UTC; fractional seconds only when there are some."""
    whole = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.date_format(c, "SSSSSS")
    return F.concat(whole, F.when(micros == "000000", "").otherwise(F.concat(F.lit("."), micros)),
                    F.lit("+00:00"))


def size_mb(c: Column) -> Column:
    return F.coalesce(F.round(c / F.lit(1048576.0), 4), F.lit(0.0))


def percent_of(part: Column, whole: Column) -> Column:
    """Two decimals, zero when there is nothing to divide by."""
    return F.when(whole > 0, F.round(part / whole * 100, 2)).otherwise(F.lit(0.0))


def millis_to_days(c: Column) -> Column:
    return c / F.lit(86400000)


def last_two_parts(c: Column) -> Column:
    """``a.b.c`` -> ``b.c``; shorter names stay as they are."""
    parts = F.split(c, r"\.")
    return F.when(F.size(parts) > 2, F.array_join(F.slice(parts, -2, 2), ".")).otherwise(c)


def label_value(labels: Column, key: str) -> Column:
    return labels[key]


def null_bucket(null_pct: Column) -> Column:
    return F.when(null_pct == 0, "good").when(null_pct < 10, "warn").otherwise("bad")


def distinct_bucket(distinct_pct: Column) -> Column:
    return F.when(distinct_pct > 80, "good").when(distinct_pct > 50, "neutral").otherwise("warn")


def coverage_bucket(count: Column) -> Column:
    return F.when(count > 0, "populated").otherwise("empty")


def layer_of(dataset: Column) -> Column:
    """First layer whose name occurs in the dataset name."""
    chain = reduce(lambda acc, name: acc.when(dataset.contains(name), name), LAYERS[1:],
                   F.when(dataset.contains(LAYERS[0]), LAYERS[0]))
    return chain.otherwise("unknown")


def layer_label(dataset: Column) -> Column:
    """``raw_ecommerce`` -> ``Raw``: first occurrence of the suffix dropped, first letter raised."""
    base = F.regexp_replace(dataset, f"^(.*?){DATASET_SUFFIX}", "$1")
    return F.concat(F.upper(F.substring(base, 1, 1)), F.substring(base, 2, 2 ** 31 - 1))


def table_kind(table_type: Column) -> Column:
    return F.when(table_type == "VIEW", "VIEW").otherwise("TABLE")


def cache_rate(cached: Column, total: Column) -> Column:
    """Whole percent, zero when there are no jobs."""
    return F.coalesce(F.round(F.try_divide(cached, total) * 100, 0), F.lit(0.0))
