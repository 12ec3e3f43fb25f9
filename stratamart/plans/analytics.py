"""Analytics marts (Q1-Q4).

Facts are reduced per join key before they meet a dimension, so joins never
multiply rows. The closing ``groupBy`` over the dimension's columns merges
dimension rows that agree in all of them, which is what the marts' definition
asks for; it contains the join key, so it reuses the join's partitioning and
adds no shuffle.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import average_of, ratio, subtract, times, to_numeric
from ..operators.skew import left_join_apart

# Least number of distinct orders for each segment, best first.
SEGMENTS = [("VIP", 5), ("Regular", 3), ("Occasional", 1)]
LAST_SEGMENT = "Prospect"

# Order states that count as revenue.
REVENUE_STATUSES = ["completed", "shipped"]


def segment_of(orders: Column, segments=None) -> Column:
    chain = F
    for name, least in segments or SEGMENTS:
        chain = chain.when(orders >= least, name)
    return chain.otherwise(LAST_SEGMENT)


def as_day(as_of: dt.date | None) -> Column:
    return F.current_date() if as_of is None else F.lit(as_of)


def customer_360(customers: DataFrame, orders: DataFrame, as_of: dt.date | None = None,
                 segments=None) -> DataFrame:
    """Profile, order metrics over every order status, and segment."""
    per_customer = orders.where(F.col("customer_id").isNotNull()).groupBy("customer_id").agg(
        F.count_distinct("order_id").alias("n_orders"),
        F.sum("total_amount").alias("revenue"),
        F.count("total_amount").alias("n_amounts"),
        F.max("order_date").alias("last_day"),
        F.min("order_date").alias("first_day"),
        F.count_if(F.col("order_status") == "completed").alias("n_completed"),
        F.count_if(F.col("order_status") == "returned").alias("n_returned"),
        F.count_if(F.col("order_status") == "cancelled").alias("n_cancelled"))
    profile = ["customer_id", "first_name", "last_name", "email", "city", "state", "country",
               "created_at"]
    joined = customers.select(*profile).join(per_customer, "customer_id", "left")
    total = F.coalesce(F.max("n_orders"), F.lit(0))
    return joined.groupBy(*profile).agg(
        total.alias("total_orders"),
        F.coalesce(to_numeric(F.sum("revenue")), to_numeric(F.lit(0))).alias("lifetime_revenue"),
        F.coalesce(average_of(F.sum("revenue"), F.sum("n_amounts")), to_numeric(F.lit(0))).alias("avg_order_value"),
        F.max("last_day").alias("last_order_date"),
        F.min("first_day").alias("first_order_date"),
        F.coalesce(F.sum("n_completed"), F.lit(0)).alias("completed_orders"),
        F.coalesce(F.sum("n_returned"), F.lit(0)).alias("returned_orders"),
        F.coalesce(F.sum("n_cancelled"), F.lit(0)).alias("cancelled_orders"),
        segment_of(total, segments).alias("customer_segment"),
    ).select(
        *profile[:-1], F.col("created_at").alias("account_created_at"),
        F.date_diff(as_day(as_of), F.to_date("created_at")).cast("long").alias("account_age_days"),
        "total_orders", "lifetime_revenue", "avg_order_value", "last_order_date", "first_order_date",
        "completed_orders", "returned_orders", "cancelled_orders", "customer_segment")


def product_performance(products: DataFrame, items: DataFrame, orders: DataFrame) -> DataFrame:
    """Units, revenue, margin, orders and buyers per product; unsold products keep NULL margin_pct.

    Items and orders are each shuffled once, by order: buyers, join and the
    reduction to one row per order, product and buyer all reuse that. Orders are
    then counted as rows, which leaves a single distinct count, the buyers.
    """
    # Repeated copies of an order multiply its items; carry the number of copies instead of the rows.
    buyers = orders.where(F.col("order_id").isNotNull()).select("order_id", "customer_id").repartition("order_id").groupBy(
        "order_id", "customer_id").agg(F.count("*").alias("copies"))
    # An order under several customers counts once: on the first of them.
    one = F.row_number().over(W.partitionBy("order_id").orderBy(F.col("customer_id").asc_nulls_first()))
    buyers = buyers.withColumn("first_buyer", one == 1)
    sold = (items.where(F.col("product_id").isNotNull())
            .select("product_id", "order_id", "quantity", "subtotal").repartition("order_id")
            .join(buyers, "order_id", "left"))
    repeated = F.col("copies") > 1
    per_order = sold.groupBy("order_id", "product_id", "customer_id", "first_buyer").agg(
        F.sum(F.when(repeated, F.col("quantity") * F.col("copies")).otherwise(F.col("quantity"))).alias("units"),
        F.sum(F.when(repeated, times(F.col("copies"), F.col("subtotal")))
              .otherwise(F.col("subtotal"))).alias("revenue"))
    per_product = per_order.groupBy("product_id").agg(
        F.sum("units").alias("units"), F.sum("revenue").alias("revenue"),
        F.count_if(F.col("order_id").isNotNull() & F.coalesce("first_buyer", F.lit(True))).alias("n_orders"),
        F.count_distinct("customer_id").alias("n_buyers"))
    profile = ["product_id", "product_name", "category", "subcategory", "brand", "unit_price",
               "cost_price", "is_active"]
    joined = products.select(*profile).join(per_product, "product_id", "left")
    units, revenue = F.sum("units"), F.sum("revenue")
    # The cost is constant within the group, so the sum of quantity * cost is cost * sum of quantity.
    margin = subtract(revenue, times(units, F.col("cost_price")))
    return joined.groupBy(*profile).agg(
        F.coalesce(units, F.lit(0)).alias("total_units_sold"),
        F.coalesce(to_numeric(revenue), to_numeric(F.lit(0))).alias("total_revenue"),
        F.coalesce(to_numeric(margin), to_numeric(F.lit(0))).alias("gross_margin"),
        ratio(margin, revenue).alias("margin_pct"),
        F.coalesce(F.max("n_orders"), F.lit(0)).alias("order_count"),
        F.coalesce(F.max("n_buyers"), F.lit(0)).alias("unique_buyers"),
    ).withColumnRenamed("unit_price", "current_price")


def revenue_daily(orders: DataFrame) -> DataFrame:
    """Revenue per day over completed and shipped orders."""
    kept = orders.where(F.col("order_status").isin(*REVENUE_STATUSES))
    gross, discounts = F.sum("total_amount"), F.sum("discount_amount")
    daily = kept.groupBy("order_date").agg(
        F.count_distinct("order_id").alias("order_count"),
        to_numeric(gross).alias("gross_revenue"),
        to_numeric(discounts).alias("total_discounts"),
        to_numeric(F.sum("tax_amount")).alias("total_tax"),
        to_numeric(subtract(gross, discounts)).alias("net_revenue"),
        to_numeric(F.avg("total_amount")).alias("avg_order_value"),
        F.count_distinct("customer_id").alias("unique_customers"))
    return daily.select(
        "order_date", F.year("order_date").cast("long").alias("year"),
        F.month("order_date").cast("long").alias("month"),
        F.dayofweek("order_date").cast("long").alias("day_of_week"),
        *daily.columns[1:])


def shipping_milestones(shipping: DataFrame) -> DataFrame:
    """First time of each milestone per order: rows turned into columns."""
    first = {alias: F.min(F.when(F.col("event_type") == kind, F.col("event_timestamp"))).alias(alias)
             for kind, alias in [("picked_up", "picked_up_at"), ("delivered", "delivered_at"),
                                 ("returned", "returned_at")]}
    return shipping.groupBy("order_id").agg(*first.values())


def order_fulfillment(orders: DataFrame, payments: DataFrame, shipping: DataFrame) -> DataFrame:
    """One row per order and distinct payment; an order paid twice has two rows.

    Orders and payments become distinct by their whole rows, merged inside the tasks, so an
    order with very many payments is spread out until the join, which may split it.
    Milestones are one row per order and join last.
    """
    base = orders.select("order_id", "customer_id", "order_date", "order_status", "shipping_method", "total_amount").distinct()
    paid = payments.select("order_id", "payment_method", "payment_status",
                           F.col("processed_at").alias("payment_processed_at")).distinct()
    joined = left_join_apart(base, paid, "order_id").join(shipping_milestones(shipping), "order_id", "left")
    return joined.select(
        *base.columns, "payment_method", "payment_status", "payment_processed_at",
        "picked_up_at", "delivered_at", "returned_at",
        F.timestamp_diff("HOUR", "picked_up_at", "delivered_at").alias("delivery_hours"))
