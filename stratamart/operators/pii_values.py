"""Personal data by value (D14): what the text columns of a table hold, whatever their names.

One pass over a table tests all text columns for all classes. A pattern finds candidates,
a rule (digit count, checksum, value range) tells real ones from lookalikes, and a column is
classified by the share of its filled rows that hold a real one. A pattern runs only on
values with a character it cannot do without.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .specs import TableSpec


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def _is_card(c: Column) -> Column:
    size = F.length(_digits(c))
    return (size >= 13) & (size <= 19) & F.call_function("luhn_check", _digits(c))


def _is_phone(c: Column) -> Column:
    size = F.length(_digits(c))
    return (size >= 8) & (size <= 15)


def _is_ssn(c: Column) -> Column:
    d = _digits(c)
    area = F.substring(d, 1, 3)
    return (area != "000") & (area != "666") & (area < "900") & (F.substring(d, 4, 2) != "00") & (F.substring(d, 6, 4) != "0000")


def _is_ip(c: Column) -> Column:
    return F.forall(F.split(c, r"\."), lambda p: (F.length(p) <= 3) & (F.substring(F.concat(F.lit("00"), p), -3, 3) <= "255"))


@dataclass(frozen=True)
class ValueRule:
    name: str
    pattern: str
    group: int
    needs: str | None
    check: Callable[[Column], Column] | None


# Classes, patterns and the group that holds the value.
VALUE_RULES = (
    ValueRule("Email Address", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}", 0, "@", None),
    ValueRule("Phone Number", r"\+[0-9][0-9 ()-]{5,18}[0-9]", 0, "+", _is_phone),
    ValueRule("Social Security Number", r"(?:^|[^0-9-])([0-9]{3}-[0-9]{2}-[0-9]{4})(?:$|[^0-9-])", 1, "-", _is_ssn),
    ValueRule("Payment Card Number", r"(?:^|[^0-9])([0-9](?:[ -]?[0-9]){12,18})(?:$|[^0-9])", 1, None, _is_card),
    ValueRule("IP Address", r"(?:^|[^0-9.])([0-9]+(?:\.[0-9]+){3})(?:$|[^0-9.])", 1, ".", _is_ip),
)

# Least share of filled rows, in percent, for each confidence.
CONFIDENCE = (("high", 50.0), ("medium", 5.0))


def scan_values(spec: TableSpec, rules: tuple[ValueRule, ...] = VALUE_RULES) -> DataFrame:
    """One row per text column and class found in it: filled rows, rows with a hit, hits, rejected candidates, hit rate, confidence."""
    columns = [f.name for f in spec.df.schema.fields if isinstance(f.dataType, T.StringType)]
    pairs = [(c, r) for c in columns for r in rules]
    none = F.array().cast("array<string>")
    found, aggs, rows = [], [], []
    for c in columns:
        found.append(F.col(f"`{c}`").isNotNull().alias(f"filled.{c}"))
        aggs.append(F.count_if(F.col(f"`filled.{c}`")).alias(f"filled.{c}"))
    for i, (c, r) in enumerate(pairs):
        value = F.col(f"`{c}`")
        seen = F.regexp_extract_all(value, F.lit(r.pattern), F.lit(r.group))
        found.append(F.coalesce(F.when(value.contains(r.needs), seen) if r.needs else seen, none).alias(f"c{i}"))
    for i, (c, r) in enumerate(pairs):
        real = F.filter(F.col(f"c{i}"), r.check) if r.check else F.col(f"c{i}")
        aggs += [F.count_if(F.size(real) > 0).alias(f"r{i}"), F.sum(F.size(real)).alias(f"h{i}"), F.sum(F.size(f"c{i}")).alias(f"n{i}")]
        rows.append(F.struct(
            F.lit(c).alias("column_name"), F.lit(r.name).alias("pii_classification"), F.col(f"`filled.{c}`").alias("filled_rows"),
            F.col(f"r{i}").alias("rows_with_hits"), F.col(f"h{i}").cast("long").alias("hits"),
            (F.col(f"n{i}") - F.col(f"h{i}")).cast("long").alias("rejected")))
    if not pairs:
        return spec.df.sparkSession.createDataFrame([], SCAN_SCHEMA)
    rate = F.round(F.col("rows_with_hits") * 100.0 / F.col("filled_rows"), 4)
    confidence = F
    for name, least in CONFIDENCE:
        confidence = confidence.when(rate >= least, name)
    return (spec.df.select(*found).agg(*aggs).select(F.inline(F.array(*rows))).where(F.col("hits") > 0)
            .select(F.lit(spec.dataset).alias("dataset_id"), F.lit(spec.name).alias("table_name"), "*", rate.alias("hit_rate_pct"),
                    confidence.otherwise("low").alias("confidence")))


SCAN_SCHEMA = ("dataset_id string, table_name string, column_name string, pii_classification string, filled_rows long, "
               "rows_with_hits long, hits long, rejected long, hit_rate_pct double, confidence string")


def scan_tables(specs: list[TableSpec], rules: tuple[ValueRule, ...] = VALUE_RULES) -> DataFrame:
    return reduce(DataFrame.unionByName, [scan_values(s, rules) for s in specs if not s.is_view])


def by_name_and_value(by_name: DataFrame, by_value: DataFrame) -> DataFrame:
    """Both kinds of evidence side by side: a column is in if either finds it, and ``source`` tells which did."""
    key = ["dataset_id", "table_name", "column_name", "pii_classification"]
    named = by_name.select(*key, F.col("confidence").alias("name_confidence"))
    valued = by_value.select(*key, "hit_rate_pct", F.col("confidence").alias("value_confidence"))
    return named.join(valued, key, "full").withColumn("source", F.concat_ws(
        "+", F.when(F.col("name_confidence").isNotNull(), "name"), F.when(F.col("value_confidence").isNotNull(), "value")))
