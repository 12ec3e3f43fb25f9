"""Staging cleaners: text in, typed columns out (Q0a-Q0f). All but customers are map-only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import initcap_delimited, parse_date, parse_timestamp, safe_integer, safe_numeric
from ..operators.dedup import latest_per_key


def _replace(df: DataFrame, **columns) -> DataFrame:
    return df.withColumns({n: f(F.col(n)) for n, f in columns.items()})


def stg_customers(raw: DataFrame) -> DataFrame:
    latest = latest_per_key(raw, "customer_id", "_ingested_at")
    return _replace(latest, first_name=initcap_delimited, last_name=initcap_delimited, email=F.lower,
                    date_of_birth=parse_date, created_at=parse_timestamp, updated_at=parse_timestamp)


def stg_products(raw: DataFrame) -> DataFrame:
    return _replace(raw.drop("_ingested_at"), unit_price=safe_numeric, cost_price=safe_numeric,
                    weight_kg=safe_numeric, created_at=parse_date,
                    is_active=lambda c: F.when(F.lower(c) == "true", True).otherwise(False))


def stg_orders(raw: DataFrame) -> DataFrame:
    return _replace(raw, order_date=parse_date, total_amount=safe_numeric,
                    discount_amount=safe_numeric, tax_amount=safe_numeric)


def stg_order_items(raw: DataFrame) -> DataFrame:
    return _replace(raw, quantity=safe_integer, unit_price=safe_numeric, subtotal=safe_numeric)


def stg_payments(raw: DataFrame) -> DataFrame:
    return _replace(raw, amount=safe_numeric, processed_at=parse_timestamp)


def stg_shipping_events(raw: DataFrame) -> DataFrame:
    return _replace(raw, event_timestamp=parse_timestamp)


STAGING = {
    "customers": stg_customers, "products": stg_products, "orders": stg_orders,
    "order_items": stg_order_items, "payments": stg_payments, "shipping_events": stg_shipping_events,
}
