"""Column profiler and quality reports.

All columns of a table are profiled together, in two narrow passes. Row counts and the
moments of numbers come from one aggregate over one scan. Everything that the different
values tell comes from a second pass in long form: every cell becomes (column, value),
equal pairs merge inside each task before the shuffle and keep how many they were, and
the shuffle spreads by value, so neither a hot value nor a wide table ends up in one
task. Distinct and filled counts, text lengths and extremes of times are read off these
pairs. With ``distinct="approx"`` the first aggregate has all figures and a sketch, and
the second pass disappears.
"""

from __future__ import annotations

import re
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.display import percent_of
from .skew import stored
from .specs import TableSpec

# Fixed value: the note on views, which are not profiled.
VIEW_NOTE = "View -- profile by querying through view"

# Longer values are shuffled as a digest of the whole value.
MAX_PLAIN_VALUE = 64

PROFILE_SCHEMA = T.StructType([T.StructField(n, t) for n, t in [
    ("dataset_id", T.StringType()), ("table_name", T.StringType()), ("ordinal_position", T.LongType()),
    ("column_name", T.StringType()), ("data_type", T.StringType()), ("total_rows", T.LongType()),
    ("null_count", T.LongType()), ("null_pct", T.DoubleType()), ("distinct_count", T.LongType()),
    ("uniqueness_pct", T.DoubleType()), ("min_number", T.DoubleType()), ("max_number", T.DoubleType()),
    ("mean", T.DoubleType()), ("stddev", T.DoubleType()), ("min_text", T.StringType()),
    ("max_text", T.StringType()), ("min_length", T.LongType()), ("max_length", T.LongType()),
    ("avg_length", T.DoubleType()), ("status", T.StringType())]])


def _is_time(t: T.DataType) -> bool:
    return isinstance(t, (T.TimestampType, T.TimestampNTZType, T.DateType))


def _text(c: Column, t: T.DataType) -> Column | None:
    """The text form of values that are compared as text, whatever their length."""
    if isinstance(t, T.StringType):
        return c
    if isinstance(t, T.BinaryType):
        return F.base64(c)
    if isinstance(t, T.MapType):
        return F.to_json(F.array_sort(F.map_entries(c)))
    if isinstance(t, (T.ArrayType, T.StructType)):
        return F.when(c.isNotNull(), F.to_json(c))
    return None


def _comparable(c: Column, t: T.DataType, utc: bool) -> tuple[str, Column] | None:
    """A value that is equal exactly when the cells are, and the slot of the long form it goes to.

    Numbers, flags and times keep a fixed-width slot; other values become text.
    None for types whose values cannot be compared.
    """
    if isinstance(t, (T.FloatType, T.DoubleType)):
        return "d", c.cast("double")
    if isinstance(t, (T.IntegralType, T.BooleanType)):
        return "l", c.cast("long")
    if isinstance(t, T.DateType):
        return "l", F.unix_date(c).cast("long")
    if isinstance(t, T.TimestampType) or (isinstance(t, T.TimestampNTZType) and utc):
        return "l", F.unix_micros(c.cast("timestamp"))
    if isinstance(t, (T.DecimalType, T.TimestampNTZType)):
        return "t", c.cast("string")
    text = _text(c, t)
    # A digest with the length behind it is longer than any plain value, so the two never meet.
    return None if text is None else ("t", F.when(F.length(text) <= MAX_PLAIN_VALUE, text).otherwise(
        F.concat(F.sha2(text, 256), F.lit(":"), F.length(text))))


def comparable_value(c: Column, t: T.DataType, utc: bool) -> Column | None:
    """A value that is equal exactly when the cells are, or None for types that cannot be compared.

    Stored sketches hold hashes of it, so its form stays as it is.
    """
    text = _text(c, t)
    if text is not None:
        return F.when(F.length(text) <= MAX_PLAIN_VALUE, F.concat(F.lit("v"), text)).otherwise(
            F.concat(F.lit("h"), F.sha2(text, 256)))
    key = _comparable(c, t, utc)
    return None if key is None else key[1]


def _value_figures(df: DataFrame, keyed: dict[int, tuple[str, Column]], figures: bool) -> DataFrame:
    """A row per column with a value: its different and filled cells, and the lengths and extremes of the values."""
    slots = {"l": "long", "d": "double", "t": "string"}
    used = [s for s in slots if any(k[0] == s for k in keyed.values())]
    cells: list[Column] = []
    for i, (slot, value) in keyed.items():
        cells += [F.lit(i), *[value if s == slot else F.lit(None).cast(slots[s]) for s in used]]
    long = df.select(F.stack(F.lit(len(keyed)), *cells).alias("i", *used))
    filled = reduce(lambda a, b: a | b, [F.col(s).isNotNull() for s in used])
    values = long.where(filled).groupBy("i", *used).agg(F.count("*").alias("n"))
    aggs = [F.count("*").alias("n_distinct"), F.sum("n").alias("n_present")]
    if figures and "l" in used:
        aggs += [F.min("l").alias("l_min"), F.max("l").alias("l_max")]
    if figures and "t" in used:
        size = F.when(F.length("t") <= MAX_PLAIN_VALUE, F.length("t").cast("long")).otherwise(
            F.split_part("t", F.lit(":"), F.lit(2)).try_cast("long"))
        aggs += [F.min(size).alias("t_min"), F.max(size).alias("t_max"), F.sum(size * F.col("n")).alias("t_sum")]
    return values.groupBy("i").agg(*aggs)


def _instant(micros: Column, t: T.DataType) -> Column:
    if isinstance(t, T.DateType):
        return F.date_from_unix_date(micros.cast("int"))
    return F.timestamp_micros(micros).cast(t)


def profile_table(spec: TableSpec, distinct: str = "exact", rsd: float = 0.05, figures: bool = True) -> DataFrame:
    """One row per column of one table. Without ``figures`` only counts are filled in."""
    df, fields = spec.df, spec.df.schema.fields
    dbl, txt = T.DoubleType(), T.StringType()
    none = lambda t: F.lit(None).cast(t)
    aggs: list[Column] = [F.count("*").alias("total")]
    utc = df.sparkSession.conf.get("spark.sql.session.timeZone") == "UTC"
    keyed: dict[int, tuple[str, Column]] = {}
    rows: list[Column] = []
    texts: list[int] = []
    times: dict[int, T.DataType] = {}
    for i, f in enumerate(fields):
        c, t = F.col(f"`{f.name}`"), f.dataType
        key = _comparable(c, t, utc)
        number = [none(dbl)] * 4
        text = [none(txt)] * 2
        lengths = [none(T.LongType())] * 2 + [none(dbl)]
        present = approx = none(T.LongType())
        if key is None or distinct == "approx":
            aggs.append(F.count(c).alias(f"n{i}"))
            present = F.col(f"n{i}")
        if figures and isinstance(t, T.NumericType):
            x = c.cast("double")
            aggs += [F.min(x).alias(f"a{i}"), F.max(x).alias(f"b{i}"), F.avg(x).alias(f"m{i}"),
                     F.stddev_samp(x).alias(f"s{i}")]
            number = [F.col(f"a{i}"), F.col(f"b{i}"), F.round(f"m{i}", 4), F.round(f"s{i}", 4)]
        elif figures and isinstance(t, T.StringType):
            if distinct == "approx":
                size = F.length(c)
                aggs += [F.min(size).alias(f"a{i}"), F.max(size).alias(f"b{i}"), F.avg(size).alias(f"m{i}")]
                lengths = [F.col(f"a{i}").cast("long"), F.col(f"b{i}").cast("long"), F.round(f"m{i}", 1)]
            else:
                texts.append(i)
        elif figures and _is_time(t):
            if distinct == "approx" or key[0] != "l":
                aggs += [F.min(c).alias(f"a{i}"), F.max(c).alias(f"b{i}")]
                text = [F.col(f"a{i}").cast("string"), F.col(f"b{i}").cast("string")]
            else:
                times[i] = t
        if key is not None:
            keyed[i] = key
            if distinct == "approx":
                aggs.append(F.approx_count_distinct(c if isinstance(t, T.AtomicType) else comparable_value(c, t, utc), rsd).alias(f"d{i}"))
                approx = F.col(f"d{i}")
        names = ["i", "column_name", "data_type", "present", "min_number", "max_number", "mean", "stddev",
                 "min_text", "max_text", "min_length", "max_length", "avg_length", "approx"]
        values = [F.lit(i), F.lit(f.name), F.lit(t.simpleString()), present, *number, *text,
                  *lengths, approx]
        rows.append(F.struct(*[v.alias(n) for n, v in zip(names, values)]))
    stats = df.agg(*aggs).select("total", F.inline(F.array(*rows)))
    known = F.col("i").isin(*keyed) if keyed else F.lit(False)
    if distinct == "approx" or not keyed:
        found = stats.withColumn("n_distinct", F.col("approx"))
    else:
        found = stats.join(F.broadcast(_value_figures(df, keyed, figures)), "i", "left")  # a row per column
        found = found.withColumn("present", F.when(known, F.coalesce("n_present", F.lit(0))).otherwise(F.col("present")))
        for i, t in times.items():
            here = F.col("i") == i
            found = found.withColumns({n: F.when(here, _instant(F.col(v), t).cast("string")).otherwise(F.col(n))
                                       for n, v in (("min_text", "l_min"), ("max_text", "l_max"))})
        if texts:
            text_row = F.col("i").isin(*texts)
            found = found.withColumns({
                "min_length": F.when(text_row, F.col("t_min")), "max_length": F.when(text_row, F.col("t_max")),
                "avg_length": F.when(text_row, F.round(F.col("t_sum").cast("double") / F.col("n_present"), 1))})
    counted = F.when(known, F.coalesce("n_distinct", F.lit(0)))
    total = F.col("total")
    return found.where(total > 0).select(
        F.lit(spec.dataset).alias("dataset_id"), F.lit(spec.name).alias("table_name"),
        (F.col("i") + 1).cast("long").alias("ordinal_position"), "column_name", "data_type",
        total.alias("total_rows"), (total - F.col("present")).alias("null_count"),
        percent_of(total - F.col("present"), total).alias("null_pct"),
        counted.alias("distinct_count"), percent_of(counted, total).alias("uniqueness_pct"),
        "min_number", "max_number", "mean", "stddev", "min_text", "max_text", "min_length",
        "max_length", "avg_length",
        F.when(known, "ok").otherwise("error: values of this type cannot be compared").alias("status"),
    ).to(PROFILE_SCHEMA)


def profile_tables(specs: list[TableSpec], distinct: str = "exact", figures: bool = True) -> DataFrame:
    """Profiles of many tables as one plan. Views give one note row; empty tables give none."""
    parts = []
    for s in specs:
        if s.is_view:
            note = s.df.sparkSession.range(1).select(
                F.lit(s.dataset).alias("dataset_id"), F.lit(s.name).alias("table_name"),
                F.lit(VIEW_NOTE).alias("status"))
            parts.append(note.to(PROFILE_SCHEMA))
        else:
            parts.append(profile_table(s, distinct, figures=figures))
    return reduce(DataFrame.unionByName, parts)


# The first bracketed name in a failure's text is its error condition.
_CONDITION = re.compile(r"\[([A-Z][A-Z0-9_]+(?:\.[A-Z0-9_]+)*)\]")


def profile_isolated(spec: TableSpec, distinct: str = "exact") -> DataFrame:
    """The profile of a table some of whose columns fail while they are computed.

    All columns are profiled together and the result is written. If that fails with an
    error condition of the data, the columns are halved until each failing one stands alone: it
    gets an error row with the condition's name, every other column its profile. Without a
    failure it is one run; a failing column adds two runs per halving. Failures
    without a condition, such as lost machines, are raised.
    """
    parts: list[DataFrame] = []

    def attempt(columns: list[str]) -> None:
        try:
            part = replace(spec, df=spec.df.select(*[F.col(f"`{c}`") for c in columns]))
            parts.append(stored(profile_table(part, distinct), "profile"))
        except Exception as e:
            found = [c for c in _CONDITION.findall(str(e)) if c not in ("TASK_WRITE_FAILED", "INTERNAL_ERROR")]
            if not found:
                raise
            if len(columns) > 1:
                attempt(columns[:len(columns) // 2])
                attempt(columns[len(columns) // 2:])
                return
            field = spec.df.schema[columns[0]]
            parts.append(spec.df.sparkSession.range(1).select(
                F.lit(spec.dataset).alias("dataset_id"), F.lit(spec.name).alias("table_name"), F.lit(field.name).alias("column_name"),
                F.lit(field.dataType.simpleString()).alias("data_type"), F.lit(f"error: {found[0]}").alias("status")).to(PROFILE_SCHEMA))

    attempt(spec.df.columns)
    place = F.create_map(*[F.lit(x) for i, c in enumerate(spec.df.columns) for x in (c, i + 1)])
    return reduce(DataFrame.unionByName, parts).withColumn(
        "ordinal_position", F.element_at(place, F.col("column_name")).cast("long")).to(PROFILE_SCHEMA)


def quality_rows(profile: DataFrame) -> DataFrame:
    """One row per profiled column for display: missing figures become zero."""
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    return profile.where(F.col("column_name").isNotNull()).select(
        F.concat_ws(".", "dataset_id", "table_name").alias("table"), "dataset_id", "table_name",
        "column_name", "data_type", zero("null_pct"), zero("null_count"),
        F.coalesce("uniqueness_pct", F.lit(0)).alias("distinct_pct"), zero("distinct_count"),
        zero("total_rows"), "min_number", "max_number", "min_text", "max_text", "mean", "stddev",
        "min_length", "max_length", "avg_length")


def quality_summary(rows: DataFrame) -> DataFrame:
    d, n = F.col("distinct_pct"), F.col("null_pct")
    return rows.agg(
        F.count("*").alias("total"), F.count_if(n > 0).alias("with_nulls"),
        F.count_if((d > 0) & (d < 50)).alias("low_distinct"), F.count_if(n > 50).alias("high_null"))
