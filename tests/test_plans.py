"""Shapes the physical plans must keep."""

import re

from stratamart.queries import REGISTRY
from stratamart.queries.pipeline import mart

def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scans(plan):
    return re.findall(r"ReadSchema: struct<([^>]*)>", plan)


def test_scans_are_narrow(spark, sf_dir):
    plan = plan_of(REGISTRY["Q3_revenue_daily"].run(spark, sf_dir))
    assert plan.count("FileScan") == 1
    plan = plan_of(REGISTRY["D9_partition_stats"].run(spark, sf_dir))
    assert "o_totalprice" not in plan
    assert all("," not in s for s in scans(plan)) or "o_custkey" not in plan


def test_filters_reach_the_scan(spark, sf_dir):
    plan = plan_of(REGISTRY["P3_in_list"].run(spark, sf_dir))
    assert "PushedFilters: [In(o_orderstatus" in plan
    plan = plan_of(REGISTRY["M3_retention"].run(spark, sf_dir))
    assert "GreaterThan(o_orderdate" in plan


def test_top_k_is_not_a_global_sort(spark, sf_dir):
    assert "TakeOrderedAndProject" in plan_of(REGISTRY["O3_top_k_latest"].run(spark, sf_dir))


def test_dedup_reduces_before_the_shuffle(spark, sf_dir):
    plan = plan_of(REGISTRY["W1_latest_per_key"].run(spark, sf_dir))
    assert "Window" not in plan and "partial_max" in plan and plan.count("Exchange") == 1


def test_customer_360_adds_no_shuffle_after_the_join(spark, sf_dir):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(mart(spark, sf_dir, "customer_360"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    before_join = plan.split("SortMergeJoin [customer_id")[0]
    assert "Exchange" not in before_join


def exchanges(plan):
    return re.findall(r"Exchange hashpartitioning\(([^)]*)\)", re.sub(r"#\d+L?", "", plan))


def no_broadcast(spark, build):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return plan_of(build())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_product_performance_shuffles_each_table_once(spark, sf_dir):
    plan = no_broadcast(spark, lambda: mart(spark, sf_dir, "product_performance"))
    assert "Expand" not in plan
    by_order = [e for e in exchanges(plan) if e.startswith("order_id")]
    assert len(by_order) == 2  # items and orders


def test_order_fulfillment_shuffles_each_table_once(spark, sf_dir):
    plan = no_broadcast(spark, lambda: mart(spark, sf_dir, "order_fulfillment"))
    assert len(exchanges(plan)) == 3 and all(e.startswith("order_id") for e in exchanges(plan))


def test_constraint_checks_share_their_shuffles(spark, sf_dir):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = no_broadcast(spark, lambda: REGISTRY["D13_constraint_report"].run(spark, sf_dir))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plan.count("ReusedExchange") >= 6
