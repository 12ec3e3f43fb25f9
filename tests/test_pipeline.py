"""The layers on the invented rows; expected values worked out by hand."""

import datetime as dt
from decimal import Decimal as D

from pyspark.sql import functions as F

from stratamart.plans import analytics, pipeline, reporting
from stratamart.plans.staging import STAGING

AS_OF = dt.date(2024, 6, 1)


def rows(df, *key):
    return {tuple(r[k] for k in key) if len(key) > 1 else r[key[0]]: r for r in df.collect()}


def stg(shop, name):
    return STAGING[name](shop[name])


def c360(shop, **kw):
    return analytics.customer_360(stg(shop, "customers"), stg(shop, "orders"), AS_OF, **kw)


def test_staging_columns_and_counts(shop):
    widths = {"customers": 16, "products": 11, "orders": 14, "order_items": 7, "payments": 11, "shipping_events": 9}
    for name, width in widths.items():
        assert len(stg(shop, name).columns) == width
    assert stg(shop, "customers").count() == 6
    assert stg(shop, "orders").count() == shop["orders"].count()


def test_staged_customers(shop):
    got = rows(stg(shop, "customers"), "customer_id")
    assert (got["K1"].first_name, got["K1"].last_name, got["K1"].email) == ("Mary-Jane", "O'hara", " mary@mail.no ")
    assert got["K2"].city == "new"
    assert got["K3"].date_of_birth is None and got["K3"].created_at is None
    assert got["K4"].first_name is None and got["K4"].city == "B"  # greatest remaining columns
    assert got["K5"].date_of_birth == dt.date(1990, 1, 5)


def test_staged_values_that_do_not_parse(shop):
    assert {r.product_id: r.is_active for r in stg(shop, "products").collect()} == {
        "A": True, "B": True, "C": False, "D": False, "E": True}
    o5 = rows(stg(shop, "orders"), "order_id")["O5"]
    assert o5.order_date is None and o5.total_amount is None
    assert stg(shop, "orders").first().tax_amount == D("5.123456789")
    assert stg(shop, "order_items").where("quantity is null").count() == 1


def test_customer_360(shop):
    df = c360(shop)
    assert len(df.columns) == 18
    got = rows(df, "customer_id")
    assert len(got) == 6
    k1 = got["K1"]
    assert (k1.total_orders, k1.lifetime_revenue, k1.avg_order_value) == (3, D("150"), D("50"))
    assert (k1.completed_orders, k1.returned_orders, k1.cancelled_orders) == (1, 0, 1)
    assert (k1.first_order_date, k1.last_order_date) == (dt.date(2024, 3, 1), dt.date(2024, 3, 2))
    assert k1.account_age_days == (AS_OF - dt.date(2023, 1, 15)).days
    assert got["K3"].lifetime_revenue == 0 and got["K3"].total_orders == 1 and got["K3"].account_age_days is None
    assert {k: r.customer_segment for k, r in got.items()} == {
        "K1": "Regular", "K2": "Occasional", "K3": "Occasional", "K4": "Prospect", "K5": "VIP", "K6": "Prospect"}


def test_segment_thresholds_are_parameters(shop):
    got = rows(c360(shop, segments=[("Top", 3), ("Some", 1)]), "customer_id")
    assert got["K1"].customer_segment == "Top" and got["K2"].customer_segment == "Some"


def test_duplicate_profiles_merge_like_the_definition(shop, spark):
    """Two customers equal in all grouping columns become one row with doubled sums."""
    customers = stg(shop, "customers").where("customer_id = 'K1'")
    doubled = customers.union(customers)
    got = analytics.customer_360(doubled, stg(shop, "orders"), AS_OF).collect()
    assert len(got) == 1 and got[0].lifetime_revenue == D("300") and got[0].total_orders == 3
    assert got[0].avg_order_value == D("50") and got[0].completed_orders == 2


def test_product_performance(shop):
    df = analytics.product_performance(stg(shop, "products"), stg(shop, "order_items"), stg(shop, "orders"))
    assert len(df.columns) == 14
    got = rows(df, "product_id")
    a = got["A"]
    assert (a.total_units_sold, a.total_revenue, a.gross_margin) == (8, D("80"), D("48"))
    assert a.margin_pct == D("0.6") and (a.order_count, a.unique_buyers) == (4, 2)
    b = got["B"]  # one unreadable quantity: its subtotal counts, its cost does not
    assert (b.total_units_sold, b.total_revenue, b.gross_margin) == (2, D("76.5"), D("16.5"))
    assert b.margin_pct == D("0.215686275")
    assert got["C"].total_revenue == 0 and got["C"].margin_pct is None  # divisor zero
    assert got["D"].total_units_sold == 0 and got["D"].margin_pct is None
    assert got["E"].gross_margin == 0 and got["E"].margin_pct is None  # no cost


def test_repeated_order_rows_fan_out(shop):
    orders = stg(shop, "orders")
    twice = orders.union(orders.where("order_id = 'O1'"))
    got = rows(analytics.product_performance(stg(shop, "products"), stg(shop, "order_items"), twice), "product_id")
    assert (got["A"].total_units_sold, got["A"].total_revenue, got["A"].order_count) == (11, D("110"), 4)


def test_revenue_daily(shop):
    df = analytics.revenue_daily(stg(shop, "orders"))
    assert len(df.columns) == 11
    got = rows(df, "order_date")
    d = got[dt.date(2024, 3, 1)]
    assert (d.order_count, d.gross_revenue, d.net_revenue, d.unique_customers) == (1, D("100"), D("90"), 1)
    assert (d.year, d.month, d.day_of_week) == (2024, 3, 6)
    undated = got[None]
    assert undated.order_count == 1 and undated.gross_revenue is None and undated.avg_order_value is None
    assert got[dt.date(2024, 3, 5)].order_count == 1


def fulfilment(shop):
    return analytics.order_fulfillment(stg(shop, "orders"), stg(shop, "payments"), stg(shop, "shipping_events"))


def test_order_fulfillment(shop):
    df = fulfilment(shop)
    assert len(df.columns) == 13
    got = rows(df, "order_id", "payment_method")
    assert df.count() == 13 and ("O6", "paypal") in got and ("O6", "credit_card") in got
    assert got["O1", "credit_card"].delivery_hours == 19
    assert got["O2", "paypal"].delivery_hours == 0
    assert got["O4", "credit_card"].delivery_hours is None and got["O4", "credit_card"].returned_at is not None
    assert got["O6", "paypal"].delivery_hours == -24
    assert got["O7", None].picked_up_at is None


def test_fulfillment_of_an_order_with_very_many_payments(shop):
    """A third of all payments for one order: each different payment is a row, repeated ones are not."""
    payments = stg(shop, "payments")
    many = payments.where("order_id = 'O1'").limit(1).crossJoin(shop["orders"].sparkSession.range(3000)).withColumn(
        "gateway_reference", F.col("id").cast("string")).withColumn(
        "processed_at", F.timestamp_seconds(F.col("id") % 1000)).drop("id")
    df = analytics.order_fulfillment(stg(shop, "orders"), payments.unionByName(many), stg(shop, "shipping_events"))
    assert df.count() == fulfilment(shop).count() + 1000
    others = df.where("order_id <> 'O1'")
    assert sorted(map(str, others.collect())) == sorted(map(str, fulfilment(shop).where("order_id <> 'O1'").collect()))


def test_reports(shop):
    m = pipeline.marts(pipeline.stage_all(shop), AS_OF)
    r = pipeline.reports(m)
    kpis = {x.kpi_name: (x.kpi_value, x.unit) for x in r["v_executive_kpis"].collect()}
    assert kpis == {"Total Revenue": ("209.05", "USD"), "Total Orders": ("9", "count"),
                    "Avg Order Value": ("27.51", "USD"), "VIP Customers": ("1", "count")}
    seg = rows(r["v_customer_segments"], "customer_segment")
    assert seg["Prospect"].customer_count == 2 and seg["Prospect"].avg_lifetime_revenue == 0
    assert seg["Occasional"].total_returns == 1 and seg["Occasional"].avg_lifetime_revenue == D("35.25")
    cat = rows(r["v_category_performance"], "category")
    assert cat["Desk"].product_count == 4 and cat["Desk"].avg_margin_pct == D("40.8")
    assert cat["Lamp"].avg_margin_pct is None
    sla = rows(r["v_fulfillment_sla"], "shipping_method", "order_status")
    assert sla["standard", "completed"].delivered_within_24h == 1
    assert sla["standard", "pending"].delivered_within_24h == 0 and sla["standard", "pending"].avg_delivery_hours is None
    assert sla["express", "returned"].refunded_count == 1


def test_kpis_of_empty_marts(shop, spark):
    m = pipeline.marts({n: df.limit(0) for n, df in pipeline.stage_all(shop).items()}, AS_OF)
    kpis = {x.kpi_name: x.kpi_value for x in reporting.executive_kpis(m["revenue_daily"], m["customer_360"]).collect()}
    assert kpis == {"Total Revenue": None, "Total Orders": None, "Avg Order Value": None, "VIP Customers": "0"}


def test_segment_snapshot_order(shop):
    got = reporting.customer_segment_daily(c360(shop), AS_OF).collect()
    counts = [r.customer_count for r in got]
    assert counts == sorted(counts, reverse=True) and got[0].snapshot_date == AS_OF


def test_current_date_is_the_default(shop):
    df = analytics.customer_360(stg(shop, "customers"), stg(shop, "orders"))
    ages = df.where("customer_id = 'K1'").select("account_age_days", F.current_date().alias("t")).first()
    assert ages.account_age_days == (ages.t - dt.date(2023, 1, 15)).days
