"""Q0-Q9, R5, S4 and the layer patterns behind them."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from ..plans import analytics, reporting
from ..plans.staging import STAGING
from ..sources import retail
from .layers_sql import MARGIN_PCT, MONEY_COLUMNS, half_up, with_layers
from .registry import query

AS_OF = dt.date(2024, 12, 31)


def staged(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return STAGING[name](retail.raw(spark, sf_dir, name))


def mart(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    s = lambda n: staged(spark, sf_dir, n)
    if name == "customer_360":
        return analytics.customer_360(s("customers"), s("orders"), AS_OF)
    if name == "product_performance":
        return analytics.product_performance(s("products"), s("order_items"), s("orders"))
    if name == "revenue_daily":
        return analytics.revenue_daily(s("orders"))
    return analytics.order_fulfillment(s("orders"), s("payments"), s("shipping_events"))


def _staging_queries() -> None:
    for letter, name in zip("abcdef", STAGING):
        money = MONEY_COLUMNS.get(name)
        replace = " REPLACE (" + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in money) + ")" if money else ""
        query(f"Q0{letter}_stg_{name}", with_layers(f"SELECT *{replace} FROM stg_{name}", name))(
            lambda spark, sf_dir, name=name: staged(spark, sf_dir, name))


_staging_queries()

query("Q1_customer_360", with_layers(
    "SELECT * EXCLUDE (revenue_units) FROM customer_360", "customer_360"))(
    lambda spark, sf_dir: mart(spark, sf_dir, "customer_360"))

query("Q2_product_performance", with_layers(
    f"SELECT * EXCLUDE (margin_num, margin_den), {MARGIN_PCT} AS margin_pct FROM product_performance",
    "product_performance"))(
    lambda spark, sf_dir: mart(spark, sf_dir, "product_performance"))

query("Q3_revenue_daily", with_layers(
    "SELECT * EXCLUDE (net_units) FROM revenue_daily", "revenue_daily"))(
    lambda spark, sf_dir: mart(spark, sf_dir, "revenue_daily"))

query("Q4_order_fulfillment", with_layers("SELECT * FROM order_fulfillment", "order_fulfillment"))(
    lambda spark, sf_dir: mart(spark, sf_dir, "order_fulfillment"))


def _number_text(units: str, digits: int) -> str:
    """Integer-coded amount as decimal text without trailing zeros."""
    whole = f"CAST(CAST({units} AS HUGEINT) // {10 ** digits} AS VARCHAR)"
    rest = f"lpad(CAST(CAST({units} AS HUGEINT) % {10 ** digits} AS VARCHAR), {digits}, '0')"
    return f"regexp_replace({whole} || '.' || {rest}, '[.]?0+$', '')"


_AOV_UNITS = "CAST(round(avg_order_value * 1e9) AS HUGEINT)"


@query("Q5_executive_kpis", with_layers(f"""
SELECT 'Total Revenue' AS kpi_name, {_number_text('sum(net_units)', 4)} AS kpi_value, 'USD' AS unit FROM revenue_daily
UNION ALL SELECT 'Total Orders', CAST(sum(order_count) AS VARCHAR), 'count' FROM revenue_daily
UNION ALL SELECT 'Avg Order Value', {_number_text(
    f"CAST(round({half_up(f'sum({_AOV_UNITS})', 'count(avg_order_value)', 9, 2)} * 100) AS HUGEINT)", 2)}, 'USD' FROM revenue_daily
UNION ALL SELECT 'VIP Customers', CAST(count(*) FILTER (WHERE customer_segment = 'VIP') AS VARCHAR), 'count' FROM customer_360
""", "revenue_daily", "customer_360"))
def executive_kpis(spark, sf_dir):
    return reporting.executive_kpis(mart(spark, sf_dir, "revenue_daily"), mart(spark, sf_dir, "customer_360"))


_REV = "sum(coalesce(revenue_units, 0))"
_AOV = f"sum({_AOV_UNITS})"


@query("Q6_customer_segments", with_layers(f"""
SELECT customer_segment, count(*) AS customer_count, {half_up(_REV, 'count(*)', 4, 2)} AS avg_lifetime_revenue,
 {half_up(_AOV, 'count(*)', 9, 2)} AS avg_order_value, {half_up('sum(total_orders)', 'count(*)', 0, 1)} AS avg_orders_per_customer,
 CAST(sum(returned_orders) AS BIGINT) AS total_returns FROM customer_360 GROUP BY customer_segment""", "customer_360"))
def customer_segments(spark, sf_dir):
    return reporting.customer_segments(mart(spark, sf_dir, "customer_360"))


@query("Q7_category_performance", with_layers(f"""
SELECT category, subcategory, count(*) AS product_count, CAST(sum(total_units_sold) AS BIGINT) AS units_sold,
 CAST(sum(coalesce(margin_den, 0)) AS DOUBLE) / 10000 AS revenue,
 round(avg({MARGIN_PCT}) * 100, 1) AS avg_margin_pct, CAST(sum(unique_buyers) AS BIGINT) AS total_buyers
 FROM product_performance GROUP BY category, subcategory""", "product_performance"))
def category_performance(spark, sf_dir):
    return reporting.category_performance(mart(spark, sf_dir, "product_performance"))


@query("Q8_fulfillment_sla", with_layers("""
SELECT shipping_method, order_status, count(*) AS order_count, round(avg(delivery_hours), 1) AS avg_delivery_hours,
 count(*) FILTER (WHERE delivery_hours <= 24) AS delivered_within_24h,
 count(*) FILTER (WHERE payment_status = 'refunded') AS refunded_count
 FROM order_fulfillment GROUP BY shipping_method, order_status""", "order_fulfillment"))
def fulfillment_sla(spark, sf_dir):
    return reporting.fulfillment_sla(mart(spark, sf_dir, "order_fulfillment"))


SEGMENT_DAILY_SQL = with_layers(f"""
SELECT DATE '2024-12-31' AS snapshot_date, customer_segment, count(*) AS customer_count,
 {half_up(_REV, 'count(*)', 4, 2)} AS avg_lifetime_revenue, {half_up('sum(total_orders)', 'count(*)', 0, 1)} AS avg_orders,
 CAST({_REV} AS DOUBLE) / 10000 AS total_segment_revenue FROM customer_360 GROUP BY customer_segment""", "customer_360")


@query("Q9_customer_segment_daily", SEGMENT_DAILY_SQL)
def customer_segment_daily(spark, sf_dir):
    return reporting.customer_segment_daily(mart(spark, sf_dir, "customer_360"), AS_OF)
