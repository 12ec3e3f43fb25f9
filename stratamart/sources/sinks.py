"""Table writes (S3-S6) and retention of dated partitions (M3).

All writers are plain parquet. Layout work is one shuffle at most:

* partitioned tables are rebalanced on the partition column, so adaptive
  execution both splits a day that holds a large share of the rows and merges
  the small days;
* clustered tables are range-partitioned on the cluster columns plus a hash of
  the row, so that a single hot cluster value still spreads over many files
  while each file covers a narrow value range (parquet min/max skipping).
"""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _flat_columns(df: DataFrame) -> list[Column]:
    return [F.col(f.name) for f in df.schema.fields if f.dataType.typeName() != "map"]


# A hidden file beside the data: which columns the table is partitioned, sorted and bucketed by.
_LAYOUT = "_layout.json"


def _layout_file(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    file = jvm.org.apache.hadoop.fs.Path(path, _LAYOUT)
    return file.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), file


def record_layout(spark: SparkSession, path: str, partition: tuple = (), sort: tuple = (), buckets: int | None = None) -> None:
    """Note the layout of a table after its rows are committed; a later write of the table notes it anew."""
    fs, file = _layout_file(spark, path)
    out = fs.create(file, True)
    try:
        out.write(bytearray(json.dumps({"partition_columns": list(partition), "sort_columns": list(sort), "buckets": buckets}).encode()))
    finally:
        out.close()


def read_layout(spark: SparkSession, path: str) -> dict:
    """What the last writer noted; a table without a note has no layout."""
    fs, file = _layout_file(spark, path)
    if not fs.exists(file):
        return {"partition_columns": [], "sort_columns": [], "buckets": None}
    stream = fs.open(file)
    try:
        return json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()


def overwrite(df: DataFrame, path: str) -> str:
    """Full refresh: the stored table becomes the result of the query."""
    df.write.mode("overwrite").parquet(path)
    record_layout(df.sparkSession, path)
    return path


def write_partitioned(df: DataFrame, path: str, *partition_columns: str, mode: str = "overwrite",
                      dynamic: bool = False) -> str:
    """Hive-style partitioned parquet; ``dynamic`` replaces only the partitions present in ``df``."""
    out = df.hint("rebalance", *partition_columns).write.mode(mode)
    if dynamic:
        out = out.option("partitionOverwriteMode", "dynamic")
    out.partitionBy(*partition_columns).parquet(path)
    record_layout(df.sparkSession, path, partition_columns)
    return path


def clustered(df: DataFrame, *cluster_columns: str, files: int | None = None) -> DataFrame:
    """Rows laid out by up to four cluster columns."""
    if not 1 <= len(cluster_columns) <= 4:
        raise ValueError("one to four cluster columns")
    spread = F.xxhash64(*_flat_columns(df))
    keys = [F.col(c) for c in cluster_columns] + [spread]
    laid_out = df.repartitionByRange(files, *keys) if files else df.repartitionByRange(*keys)
    return laid_out.sortWithinPartitions(*cluster_columns)


def write_clustered(df: DataFrame, path: str, *cluster_columns: str, files: int | None = None) -> str:
    clustered(df, *cluster_columns, files=files).write.mode("overwrite").parquet(path)
    record_layout(df.sparkSession, path, sort=cluster_columns)
    return path


def write_partitioned_clustered(df: DataFrame, path: str, partition_column: str, *cluster_columns: str) -> str:
    """Partition folders whose files are sorted by the cluster columns (M4).

    The sort leads with the partition column, as the writer requires, so it is not repeated.
    """
    (df.hint("rebalance", partition_column)
       .sortWithinPartitions(partition_column, *cluster_columns)
       .write.mode("overwrite").partitionBy(partition_column).parquet(path))
    record_layout(df.sparkSession, path, (partition_column,), cluster_columns)
    return path


def write_bucketed(df: DataFrame, table: str, path: str, key: str, buckets: int) -> str:
    """Catalog table bucketed and sorted on a join key; joins on the key then skip their shuffle."""
    (df.repartition(buckets, key).write.mode("overwrite").option("path", path)
     .bucketBy(buckets, key).sortBy(key).saveAsTable(table))
    record_layout(df.sparkSession, path, sort=(key,), buckets=buckets)
    return table


def drop_expired_partitions(spark: SparkSession, path: str, partition_column: str,
                            as_of: dt.date, days: int) -> list[str]:
    """Delete date partitions older than ``as_of - days``; returns the dates dropped.

    A metadata operation on folders: no data file is read. The listing holds one
    entry per day, never one per row.
    """
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    cutoff, dropped = as_of - dt.timedelta(days=days), []
    for status in fs.listStatus(root):
        name, _, value = status.getPath().getName().partition("=")
        try:
            expired = name == partition_column and dt.date.fromisoformat(value) < cutoff
        except ValueError:
            continue
        if expired:
            fs.delete(status.getPath(), True)
            dropped.append(value)
    return sorted(dropped)
