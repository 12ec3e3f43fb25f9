"""Reporting views over the marts (Q5-Q9)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import plain_number_text, to_numeric
from .analytics import as_day


def executive_kpis(daily: DataFrame, customers: DataFrame) -> DataFrame:
    """Four name/value/unit rows. The average is the unweighted mean of daily means, as defined.

    Each source is aggregated once and its single row is turned into rows, so
    the daily table is read once for its three figures.
    """
    def kpi(name, value, unit):
        return F.struct(F.lit(name).alias("kpi_name"), value.alias("kpi_value"), F.lit(unit).alias("unit"))

    money = daily.agg(
        plain_number_text(F.sum("net_revenue")).alias("revenue"),
        F.sum("order_count").cast("string").alias("orders"),
        plain_number_text(F.round(F.avg("avg_order_value"), 2)).alias("aov"),
    ).select(F.inline(F.array(
        kpi("Total Revenue", F.col("revenue"), "USD"),
        kpi("Total Orders", F.col("orders"), "count"),
        kpi("Avg Order Value", F.col("aov"), "USD"))))
    vip = customers.agg(F.count_if(F.col("customer_segment") == "VIP").cast("string").alias("kpi_value"))
    return money.unionByName(vip.select(
        F.lit("VIP Customers").alias("kpi_name"), "kpi_value", F.lit("count").alias("unit")))


def customer_segments(c360: DataFrame) -> DataFrame:
    return c360.groupBy("customer_segment").agg(
        F.count("*").alias("customer_count"),
        to_numeric(F.round(F.avg("lifetime_revenue"), 2)).alias("avg_lifetime_revenue"),
        to_numeric(F.round(F.avg("avg_order_value"), 2)).alias("avg_order_value"),
        F.round(F.avg("total_orders"), 1).alias("avg_orders_per_customer"),
        F.sum("returned_orders").alias("total_returns"))


def category_performance(products: DataFrame) -> DataFrame:
    """Unsold products count in product_count but not in the mean margin."""
    return products.groupBy("category", "subcategory").agg(
        F.count("*").alias("product_count"),
        F.sum("total_units_sold").alias("units_sold"),
        to_numeric(F.sum("total_revenue")).alias("revenue"),
        to_numeric(F.round(F.avg("margin_pct") * F.lit(100), 1)).alias("avg_margin_pct"),
        F.sum("unique_buyers").alias("total_buyers"))


def fulfillment_sla(fulfilment: DataFrame) -> DataFrame:
    return fulfilment.groupBy("shipping_method", "order_status").agg(
        F.count("*").alias("order_count"),
        F.round(F.avg("delivery_hours"), 1).alias("avg_delivery_hours"),
        F.count_if(F.col("delivery_hours") <= 24).alias("delivered_within_24h"),
        F.count_if(F.col("payment_status") == "refunded").alias("refunded_count"))


def customer_segment_daily(c360: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    """Dated segment snapshot, largest segment first. The caller's scheduler runs it."""
    return c360.groupBy("customer_segment").agg(
        F.count("*").alias("customer_count"),
        to_numeric(F.round(F.avg("lifetime_revenue"), 2)).alias("avg_lifetime_revenue"),
        F.round(F.avg("total_orders"), 1).alias("avg_orders"),
        to_numeric(F.sum("lifetime_revenue")).alias("total_segment_revenue"),
    ).select(as_day(as_of).alias("snapshot_date"), "*").orderBy(
        F.col("customer_count").desc(), "customer_segment")
