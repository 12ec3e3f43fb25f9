"""Stored summaries, snapshots and retention (M1-M4)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.casts import utc_instant
from ..operators.predicates import within_days
from ..sources.sinks import write_partitioned, write_partitioned_clustered
from .analytics import revenue_daily


def daily_summary(daily: DataFrame) -> DataFrame:
    """Summary columns of the daily revenue mart."""
    return daily.select("order_date", F.col("gross_revenue").alias("total_revenue"), "order_count",
                        "unique_customers", "net_revenue", "avg_order_value")


# Folder of the orders whose date did not parse.
UNDATED = "undated"


def month_key(day: Column) -> Column:
    return F.coalesce(F.date_format(day, "yyyy-MM"), F.lit(UNDATED))


def with_month(df: DataFrame, day: str = "order_date") -> DataFrame:
    return df if "order_month" in df.columns else df.withColumn("order_month", month_key(F.col(day)))


def build_daily_summary(orders: DataFrame, path: str) -> str:
    """The summary has one row per day, so it is stored by month: a day would be a file of one row."""
    return write_partitioned(with_month(daily_summary(revenue_daily(orders))), path, "order_month")


# A partition listing is held by the driver; this many months are eight hundred years.
MAX_PARTITIONS = 10_000


def touched_values(df: DataFrame, column: str) -> list:
    """Distinct values of a partition column, for use as a literal predicate. Their number is checked."""
    found = [r[0] for r in df.select(column).distinct().limit(MAX_PARTITIONS + 1).collect()]
    if len(found) > MAX_PARTITIONS:
        raise ValueError(f"{column} has more than {MAX_PARTITIONS} values; it does not suit a partition column")
    return sorted(found)


def refresh_daily_summary(orders: DataFrame, touched: DataFrame, path: str) -> str:
    """Recompute only the months of the ``touched`` orders and replace only their folders.

    Days are recomputed from all their orders, whenever those arrived, so late
    rows are counted and a repeated refresh gives the same table. The touched months
    become a literal predicate: where orders are stored by ``order_month``, only
    those folders are listed and read.
    """
    months = touched_values(with_month(touched), "order_month")
    if not months:
        return path
    affected = with_month(orders).where(F.col("order_month").isin(months))
    fresh = with_month(daily_summary(revenue_daily(affected)))
    # A touched month may be left without revenue orders. A dynamic overwrite replaces a folder
    # only if it gets a row, so the left join leaves such a month one row without a day.
    all_months = orders.sparkSession.createDataFrame([(m,) for m in months], "order_month string")
    return write_partitioned(all_months.join(fresh, "order_month", "left"), path, "order_month", dynamic=True)


def read_daily_summary(spark: SparkSession, path: str) -> DataFrame:
    """The stored summary; placeholder rows of emptied months are not days."""
    return spark.read.parquet(path).where(F.col("order_count").isNotNull()).drop("order_month")


def snapshot_table(df: DataFrame, base_table: str, root: str, taken_at: dt.datetime) -> DataFrame:
    """Copy of a table as of an instant; returns (and records) its registry row.

    The folder carries the whole instant, so two snapshots of one day stay apart.
    Taking the same snapshot again replaces both the copy and its record.
    """
    utc = taken_at.astimezone(dt.timezone.utc) if taken_at.tzinfo else taken_at
    name = f"{base_table}_snapshot_{utc.strftime('%Y%m%dT%H%M%S%f')}"
    path = f"{root}/{name}"
    df.write.mode("overwrite").parquet(path)
    row = df.sparkSession.range(1).select(
        F.lit(name).alias("snapshot_table_name"), F.lit(base_table).alias("base_table_name"),
        utc_instant(taken_at).cast("timestamp").alias("snapshot_time"), F.lit(path).alias("path"))
    row.write.mode("overwrite").parquet(f"{root}/snapshot_registry/record={name}")
    return row


def read_snapshot(spark: SparkSession, registry_path: str, base_table: str, at: dt.datetime) -> DataFrame:
    """The newest snapshot not later than ``at``. The registry row is a single record."""
    found = (spark.read.parquet(registry_path)
             .where((F.col("base_table_name") == base_table) & (F.col("snapshot_time") <= utc_instant(at)))
             .orderBy(F.col("snapshot_time").desc()).limit(1).collect())
    if not found:
        raise LookupError(f"no snapshot of {base_table} at or before {at}")
    return spark.read.parquet(found[0]["path"])


def expires_at(as_of: Column, days: int = 90) -> Column:
    return F.timestamp_add("DAY", F.lit(days), as_of)


def retained(df: DataFrame, ts: str, as_of: dt.datetime, days: int = 90) -> DataFrame:
    """Rows still inside the retention window; on a date partition column this prunes folders."""
    return df.where(within_days(F.col(ts), as_of, days))


def store_staged_orders(orders: DataFrame, path: str, by: str = "order_date") -> str:
    """Staged orders partitioned by day, sorted by customer inside each file.

    ``by="order_month"`` suits tables whose days are far smaller than a file.
    """
    dated = with_month(orders) if by == "order_month" else orders
    return write_partitioned_clustered(dated, path, by, "customer_id")
