"""Declared lineage of the pipeline."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .lineage import edges_from

# Table edges (upstream, downstream, transform), in listing order.
TABLE_EDGES = [
    ("raw_ecommerce.customers", "staging_ecommerce.stg_customers", "CTAS with dedup + type casting"),
    ("raw_ecommerce.products", "staging_ecommerce.stg_products", "CTAS with type casting"),
    ("raw_ecommerce.orders", "staging_ecommerce.stg_orders", "CTAS with type casting"),
    ("raw_ecommerce.order_items", "staging_ecommerce.stg_order_items", "CTAS with type casting"),
    ("raw_ecommerce.payments", "staging_ecommerce.stg_payments", "CTAS with type casting"),
    ("raw_ecommerce.shipping_events", "staging_ecommerce.stg_shipping_events", "CTAS with type casting"),
    ("staging_ecommerce.stg_customers", "analytics_ecommerce.customer_360", "JOIN + aggregation"),
    ("staging_ecommerce.stg_orders", "analytics_ecommerce.customer_360", "JOIN + aggregation"),
    ("staging_ecommerce.stg_products", "analytics_ecommerce.product_performance", "JOIN + aggregation"),
    ("staging_ecommerce.stg_order_items", "analytics_ecommerce.product_performance", "JOIN + aggregation"),
    ("staging_ecommerce.stg_orders", "analytics_ecommerce.product_performance", "JOIN for customer_id"),
    ("staging_ecommerce.stg_orders", "analytics_ecommerce.revenue_daily", "Aggregation by date"),
    ("staging_ecommerce.stg_orders", "analytics_ecommerce.order_fulfillment", "JOIN + pivot"),
    ("staging_ecommerce.stg_payments", "analytics_ecommerce.order_fulfillment", "JOIN on order_id"),
    ("staging_ecommerce.stg_shipping_events", "analytics_ecommerce.order_fulfillment", "JOIN + pivot"),
    ("analytics_ecommerce.revenue_daily", "reporting_ecommerce.v_executive_kpis", "VIEW aggregation"),
    ("analytics_ecommerce.customer_360", "reporting_ecommerce.v_executive_kpis", "VIEW aggregation"),
    ("analytics_ecommerce.customer_360", "reporting_ecommerce.v_customer_segments", "VIEW grouping"),
    ("analytics_ecommerce.product_performance", "reporting_ecommerce.v_category_performance", "VIEW grouping"),
    ("analytics_ecommerce.order_fulfillment", "reporting_ecommerce.v_fulfillment_sla", "VIEW grouping"),
]

# Column edges, same layout.
COLUMN_EDGES = [
    ("raw_ecommerce.customers.customer_id", "staging_ecommerce.stg_customers.customer_id", "pass-through"),
    ("staging_ecommerce.stg_customers.customer_id", "analytics_ecommerce.customer_360.customer_id", "pass-through"),
    ("raw_ecommerce.customers.email", "staging_ecommerce.stg_customers.email", "LOWER()"),
    ("staging_ecommerce.stg_customers.email", "analytics_ecommerce.customer_360.email", "pass-through"),
    ("raw_ecommerce.customers.first_name", "staging_ecommerce.stg_customers.first_name", "INITCAP()"),
    ("staging_ecommerce.stg_customers.first_name", "analytics_ecommerce.customer_360.first_name", "pass-through"),
    ("raw_ecommerce.customers.date_of_birth", "staging_ecommerce.stg_customers.date_of_birth", "SAFE.PARSE_DATE()"),
    ("raw_ecommerce.orders.order_date", "staging_ecommerce.stg_orders.order_date", "SAFE.PARSE_DATE()"),
    ("staging_ecommerce.stg_orders.order_date", "analytics_ecommerce.revenue_daily.order_date", "pass-through"),
    ("raw_ecommerce.orders.total_amount", "staging_ecommerce.stg_orders.total_amount", "SAFE_CAST to NUMERIC"),
    ("staging_ecommerce.stg_orders.total_amount", "analytics_ecommerce.revenue_daily.gross_revenue", "SUM()"),
    ("staging_ecommerce.stg_orders.total_amount", "analytics_ecommerce.customer_360.lifetime_revenue", "SUM()"),
    ("staging_ecommerce.stg_orders.total_amount", "analytics_ecommerce.customer_360.avg_order_value", "AVG()"),
    ("staging_ecommerce.stg_orders.order_id", "analytics_ecommerce.customer_360.customer_segment", "COUNT DISTINCT -> CASE (derived)"),
    ("raw_ecommerce.products.unit_price", "staging_ecommerce.stg_products.unit_price", "SAFE_CAST to NUMERIC"),
    ("staging_ecommerce.stg_products.unit_price", "analytics_ecommerce.product_performance.current_price", "pass-through"),
    ("staging_ecommerce.stg_products.cost_price", "analytics_ecommerce.product_performance.gross_margin", "SUM(subtotal) - SUM(qty * cost_price)"),
    ("staging_ecommerce.stg_products.cost_price", "analytics_ecommerce.product_performance.margin_pct", "SAFE_DIVIDE(margin, revenue)"),
    ("raw_ecommerce.payments.card_last_four", "staging_ecommerce.stg_payments.card_last_four", "pass-through (PII)"),
    ("staging_ecommerce.stg_shipping_events.event_type", "analytics_ecommerce.order_fulfillment.delivered_at", "CASE WHEN pivot"),
    ("staging_ecommerce.stg_shipping_events.event_timestamp", "analytics_ecommerce.order_fulfillment.delivery_hours", "TIMESTAMP_DIFF()"),
    ("analytics_ecommerce.revenue_daily.net_revenue", "reporting_ecommerce.v_executive_kpis.kpi_value", "SUM -> CAST to STRING"),
    ("analytics_ecommerce.customer_360.customer_segment", "reporting_ecommerce.v_customer_segments.customer_segment", "GROUP BY"),
    ("analytics_ecommerce.customer_360.lifetime_revenue", "reporting_ecommerce.v_customer_segments.avg_lifetime_revenue", "AVG -> ROUND"),
    ("analytics_ecommerce.product_performance.total_revenue", "reporting_ecommerce.v_category_performance.revenue", "SUM by category"),
    ("analytics_ecommerce.order_fulfillment.delivery_hours", "reporting_ecommerce.v_fulfillment_sla.avg_delivery_hours", "AVG -> ROUND"),
]


def table_edges(spark: SparkSession) -> DataFrame:
    return edges_from(spark, TABLE_EDGES)


def column_edges(spark: SparkSession) -> DataFrame:
    return edges_from(spark, COLUMN_EDGES)
