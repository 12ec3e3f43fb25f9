"""Table reads."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..types import RAW_SCHEMAS


class PartitionFilterRequired(ValueError):
    """A guarded table was read without a predicate on its partition column."""


def scan(spark: SparkSession, path_or_table: str, *columns: str) -> DataFrame:
    """A parquet path (anything with a slash) or a catalog table."""
    df = spark.read.parquet(path_or_table) if "/" in path_or_table else spark.table(path_or_table)
    return df.select(*columns) if columns else df


def read_raw(spark: SparkSession, name: str, path: str, fmt: str = "parquet", **options) -> DataFrame:
    """One of the six raw tables with its declared schema; nothing is inferred.

    Text formats fail on a malformed row. With ``columnNameOfCorruptRecord=...`` and
    ``mode="PERMISSIVE"`` such rows are kept instead, their text in that column.
    """
    schema = RAW_SCHEMAS[name]
    kept = options.get("columnNameOfCorruptRecord")
    if fmt in ("csv", "json"):
        options = {"mode": "FAILFAST", **options}
        if kept:
            schema = T.StructType([*schema.fields, T.StructField(kept, T.StringType())])
    return spark.read.schema(schema).options(**options).format(fmt).load(path)


def partition_bounds(df: DataFrame, column: str) -> list[str]:
    """Planned partition filters on ``column`` that rule something out, beyond asking for a value at all."""
    leaves = df._jdf.queryExecution().sparkPlan().collectLeaves()
    found = []
    for i in range(leaves.length()):
        leaf = leaves.apply(i)
        if not leaf.getClass().getSimpleName().startswith("FileSourceScan"):
            continue
        filters = leaf.partitionFilters()
        for k in range(filters.length()):
            e = filters.apply(k)
            if e.getClass().getSimpleName() != "IsNotNull" and re.search(rf"\b{re.escape(column)}#", e.toString()):
                found.append(e.toString())
    return found


def read_partitioned(spark: SparkSession, path: str, partition_column: str, where: str | None) -> DataFrame:
    """Read a table that requires a predicate on its partition column.

    The plan decides, not the text: Spark must have turned the predicate into a
    partition filter on the column that is more than "not null". Mentioning the
    column in a comment, a string or one side of an OR is refused.
    """
    if not where:
        raise PartitionFilterRequired(f"a predicate on {partition_column} is required to read {path}")
    df = spark.read.parquet(path).where(where)
    if not partition_bounds(df, partition_column):
        raise PartitionFilterRequired(f"{where!r} does not bound {partition_column} of {path}")
    return df


def register_view(name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """A logical view: nothing runs until the view is queried."""
    df = build()
    df.createOrReplaceTempView(name)
    return df


def file_facts(df: DataFrame) -> list[Column]:
    """Per-row file columns, for grouping rows by the file they came from."""
    return [F.col("_metadata.file_path").alias("file_path"),
            F.col("_metadata.file_size").alias("file_size"),
            F.col("_metadata.file_modification_time").alias("file_modified")]
