"""The six raw text tables, derived from a TPC-H-like star schema.

The star schema has no text amounts, duplicates or broken values, so each
mapping renders the typed columns to text and damages some of them by an
expression on the row itself. Every source row is used; nothing is filtered.

What the mapping plants on purpose: customers ingested twice, unknown birth
dates and account dates, guest orders without a customer (about 60 % of all
orders, one hot NULL key), orders of unknown customers, dates and amounts that
do not parse, retired products nobody bought, products without a cost, split
payments and several shipping events per line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import pin_utc

MONEY = "decimal(18,2)"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return pin_utc(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def _tag(prefix: str, key: str) -> Column:
    return F.concat(F.lit(prefix), F.col(key).cast("string"))


def _day(c: Column) -> Column:
    return c.cast("date").cast("string")


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    versions = F.when(F.col("c_mktsegment") == "MACHINERY", F.array(F.lit(0), F.lit(1))).otherwise(
        F.array(F.lit(0)))
    lost = F.col("c_acctbal") < 0
    j = (c.join(n, c.c_nationkey == n.n_nationkey, "left")
          .join(r, n.n_regionkey == r.r_regionkey, "left")
          .withColumn("version", F.explode(versions)))
    return j.select(
        _tag("C", "c_custkey").alias("customer_id"),
        F.concat_ws("-", F.lower("c_mktsegment"), F.lower("r_name")).alias("first_name"),
        F.concat(F.lower(F.replace("c_name", F.lit("#"), F.lit(" "))),
                 F.when(F.col("version") == 1, " jr").otherwise("")).alias("last_name"),
        F.concat(F.upper("c_mktsegment"), F.lit("."), F.col("c_custkey"), F.lit("@Mail.Example")).alias("email"),
        F.concat(F.lit("+1-555-"), F.lpad(F.col("c_custkey").cast("string"), 9, "0")).alias("phone"),
        F.when(lost, "unknown").otherwise(
            _day(F.date_add(F.lit("1950-01-01").cast("date"), (F.col("c_custkey") % 18000).cast("int")))
        ).alias("date_of_birth"),
        F.when(F.col("c_mktsegment") == "FURNITURE", F.lit(None)).otherwise("F").alias("gender"),
        F.concat(F.col("c_custkey").cast("string"), F.lit(" Main Street")).alias("address_line1"),
        F.col("n_name").alias("city"),
        _tag("S", "c_nationkey").alias("state"),
        F.col("r_name").alias("country"),
        F.lpad(F.col("c_nationkey").cast("string"), 5, "0").alias("postal_code"),
        F.when(lost, "not recorded").otherwise(F.concat(
            _day(F.date_add(F.lit("2015-01-01").cast("date"), (F.col("c_custkey") % 2000).cast("int"))),
            F.lit("T10:30:00"))).alias("created_at"),
        F.lit("2024-06-01T14:22:00").alias("updated_at"),
        F.lit("crm").alias("source_system"),
        F.timestamp_add("DAY", F.col("version"), F.lit("2024-01-01 00:00:00").cast("timestamp")).alias("_ingested_at"),
    )


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    editions = F.when(F.col("p_type") == "PROMO", F.array(F.lit(""), F.lit("-OLD"))).otherwise(
        F.array(F.lit("")))
    price = F.col("p_retailprice").cast(MONEY)
    return p.withColumn("edition", F.explode(editions)).select(
        F.concat(_tag("P", "p_partkey"), F.col("edition")).alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.split_part("p_name", F.lit(" "), F.lit(2)).alias("subcategory"),
        F.col("p_brand").alias("brand"),
        price.cast("string").alias("unit_price"),
        F.when(F.col("p_size") == 1, "tbd").otherwise(
            (price * F.lit(0.6).cast("decimal(3,1)")).cast("string")).alias("cost_price"),
        F.col("p_size").cast("string").alias("weight_kg"),
        F.when(F.col("edition") == "-OLD", "false").when(F.col("p_size") >= 45, F.lit(None))
         .otherwise("TRUE").alias("is_active"),
        _day(F.date_add(F.lit("2014-01-01").cast("date"), F.col("p_size"))).alias("created_at"),
        F.lit("catalog").alias("source_system"),
        F.lit("2024-01-01 00:00:00").cast("timestamp").alias("_ingested_at"),
    )


def _order_status() -> Column:
    return (F.when(F.col("o_orderstatus") == "F", "completed")
            .when(F.col("o_orderstatus") == "O", "shipped")
            .when(F.col("o_orderpriority") == "1-URGENT", "cancelled")
            .when(F.col("o_orderpriority") == "2-HIGH", "returned")
            .otherwise("pending"))


def _urgent() -> Column:
    return F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    total = F.col("o_totalprice").cast(MONEY)
    return o.select(
        _tag("ORD-", "o_orderkey").alias("order_id"),
        F.when(F.col("o_totalprice") > 490000, _tag("GONE", "o_custkey"))
         .when(_urgent(), _tag("C", "o_custkey")).alias("customer_id"),
        F.when(F.col("o_totalprice") < 2000, "not known").otherwise(_day(F.col("o_orderdate"))).alias("order_date"),
        _order_status().alias("order_status"),
        F.when(_urgent(), "express").otherwise("standard").alias("shipping_method"),
        F.lit(None).cast("string").alias("shipping_address_city"),
        F.col("o_orderpriority").alias("shipping_address_state"),
        F.lit("US").alias("shipping_address_country"),
        F.when(F.col("o_totalprice") < 3000, "free").otherwise(total.cast("string")).alias("total_amount"),
        (total * F.lit(0.05).cast("decimal(3,2)")).cast("string").alias("discount_amount"),
        (total * F.lit(0.08).cast("decimal(3,2)")).cast("string").alias("tax_amount"),
        F.lit("USD").alias("currency"),
        F.lit("oms").alias("source_system"),
        F.col("o_orderdate").cast("timestamp").alias("_ingested_at"),
    )


def raw_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    price = F.col("l_extendedprice").cast(MONEY)
    return li.select(
        F.concat(_tag("OI-", "l_orderkey"), F.lit("-"), F.col("l_linenumber").cast("string")).alias("order_item_id"),
        _tag("ORD-", "l_orderkey").alias("order_id"),
        _tag("P", "l_partkey").alias("product_id"),
        F.when(F.col("l_quantity") == 50, "fifty").otherwise(
            F.col("l_quantity").cast("bigint").cast("string")).alias("quantity"),
        (price * F.lit(0.02).cast("decimal(3,2)")).cast("string").alias("unit_price"),
        price.cast("string").alias("subtotal"),
        F.col("l_shipdate").cast("timestamp").alias("_ingested_at"),
    )


def raw_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    parts = F.when(F.col("o_totalprice") > 400000, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    paypal = (F.col("part") == 2) | (F.col("o_orderpriority") == "5-LOW")
    status = _order_status()
    return o.withColumn("part", F.explode(parts)).select(
        F.concat(_tag("PAY-", "o_orderkey"), F.lit("-"), F.col("part").cast("string")).alias("payment_id"),
        _tag("ORD-", "o_orderkey").alias("order_id"),
        F.when(paypal, "paypal").when(_urgent(), "credit_card").otherwise("debit_card").alias("payment_method"),
        F.when(status.isin("cancelled", "returned"), "refunded").when(status == "pending", "pending")
         .otherwise("success").alias("payment_status"),
        F.col("o_totalprice").cast(MONEY).cast("string").alias("amount"),
        F.lit("USD").alias("currency"),
        F.concat(_day(F.date_add(F.col("o_orderdate").cast("date"), F.col("part"))), F.lit("T12:00:00")).alias("processed_at"),
        F.concat(_tag("ch_", "o_orderkey"), F.lit("_"), F.col("part").cast("string")).alias("gateway_reference"),
        F.when(~paypal, F.lpad((F.col("o_custkey") % 10000).cast("string"), 4, "0")).alias("card_last_four"),
        F.lit("gateway").alias("source_system"),
        F.col("o_orderdate").cast("timestamp").alias("_ingested_at"),
    )


def raw_shipping_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per line: a pickup, a delivery when the line is finished, a return when it was returned."""
    li = table(spark, sf_dir, "lineitem")
    kinds = F.array_compact(F.array(
        F.lit("picked_up"),
        F.when(F.col("l_linestatus") == "F", "delivered").otherwise("in_transit"),
        F.when(F.col("l_returnflag") == "R", "returned")))
    hours = (F.when(F.col("kind") == "picked_up", F.col("l_linenumber"))
             .when(F.col("kind") == "returned", F.lit(400))
             .otherwise(F.col("l_quantity").cast("int")))
    minutes = (hours * 50).cast("int")  # ship dates are midnights
    two = lambda n: F.lpad(n.cast("int").cast("string"), 2, "0")
    at = F.concat(_day(F.date_add(F.col("l_shipdate").cast("date"), F.floor(minutes / 1440).cast("int"))), F.lit("T"),
                  two(F.floor(minutes % 1440 / 60)), F.lit(":"), two(minutes % 60), F.lit(":00"))
    return li.withColumn("kind", F.explode(kinds)).select(
        F.concat(_tag("SE-", "l_orderkey"), F.lit("-"), F.col("l_linenumber").cast("string"), F.lit("-"),
                 F.col("kind")).alias("event_id"),
        _tag("ORD-", "l_orderkey").alias("order_id"),
        F.lit("carrier").alias("carrier"),
        _tag("T", "l_suppkey").alias("tracking_number"),
        F.col("kind").alias("event_type"),
        at.alias("event_timestamp"),
        _tag("W", "l_suppkey").alias("location"),
        F.lit("logistics").alias("source_system"),
        F.col("l_shipdate").cast("timestamp").alias("_ingested_at"),
    )


RAW_BUILDERS = {
    "customers": raw_customers, "products": raw_products, "orders": raw_orders,
    "order_items": raw_order_items, "payments": raw_payments, "shipping_events": raw_shipping_events,
}


def raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return RAW_BUILDERS[name](spark, sf_dir)
