"""Raw tables to every layer, as lazy DataFrames, and the refresh jobs that store them."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from ..sources.sinks import overwrite, write_partitioned
from . import analytics, reporting
from .staging import STAGING


def stage_all(raw: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    return {name: STAGING[name](df) for name, df in raw.items()}


def marts(stg: Mapping[str, DataFrame], as_of: dt.date | None = None) -> dict[str, DataFrame]:
    return {
        "customer_360": analytics.customer_360(stg["customers"], stg["orders"], as_of),
        "product_performance": analytics.product_performance(
            stg["products"], stg["order_items"], stg["orders"]),
        "revenue_daily": analytics.revenue_daily(stg["orders"]),
        "order_fulfillment": analytics.order_fulfillment(
            stg["orders"], stg["payments"], stg["shipping_events"]),
    }


def reports(m: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    return {
        "v_executive_kpis": reporting.executive_kpis(m["revenue_daily"], m["customer_360"]),
        "v_customer_segments": reporting.customer_segments(m["customer_360"]),
        "v_category_performance": reporting.category_performance(m["product_performance"]),
        "v_fulfillment_sla": reporting.fulfillment_sla(m["order_fulfillment"]),
    }


def refresh_customer_segments(customers: DataFrame, orders: DataFrame, path: str,
                              as_of: dt.date | None = None) -> str:
    """Stored procedure form of customer_360: rebuild and replace."""
    return overwrite(analytics.customer_360(customers, orders, as_of), path)


def refresh_segment_snapshot(c360: DataFrame, path: str, as_of: dt.date | None = None) -> str:
    """Truncate-and-write target of the nightly segment query."""
    return overwrite(reporting.customer_segment_daily(c360, as_of), path)


def store_layer(tables: Mapping[str, DataFrame], root: str, partitioned: Mapping[str, str] | None = None) -> dict[str, str]:
    """Full refresh of one layer; ``partitioned`` maps a table to its date column."""
    out = {}
    for name, df in tables.items():
        path = f"{root}/{name}"
        column = (partitioned or {}).get(name)
        out[name] = write_partitioned(df, path, column) if column else overwrite(df, path)
    return out


def load_layer(spark: SparkSession, paths: Mapping[str, str]) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(p) for name, p in paths.items()}
