"""Invented raw rows that carry every trait the staging layer has to handle."""

from __future__ import annotations

import datetime as dt

from stratamart.types import RAW_SCHEMAS

DAY1, DAY2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)


def _customer(cid, first, last, email, born="1990-01-02", created="2023-01-15T10:30:00", at=DAY1, city="Oslo"):
    return (cid, first, last, email, "+47-1", born, None, "1 Road", city, "NO-1", "NO", "0001", created,
            "2024-06-01T14:22:00", "crm", at)


CUSTOMERS = [
    _customer("K1", "mary-jane", "o'HARA", " Mary@Mail.NO "),
    _customer("K2", "OLA", "berg", "OLA@mail.no", city="old"),
    _customer("K2", "OLA", "berg", "OLA@mail.no", at=DAY2, city="new"),      # later ingestion wins
    _customer("K3", "kari", "lie", "kari@mail.no", born="1990-02-30", created="soon"),  # unparsable
    _customer("K4", None, "tie", "a@mail.no", city="A"),
    _customer("K4", None, "tie", "b@mail.no", city="B"),                    # equal ingestion time
    _customer("K5", "per", "vip", "per@mail.no", born="1990-1-5"),          # lenient date
    _customer("K6", "no", "orders", "no@mail.no"),                          # prospect
]


def _product(pid, price="10.00", cost="4.00", active="true", category="Desk"):
    return (pid, f"name {pid}", category, "sub", "brand", price, cost, "1.5", active, "2022-05-01", "cat", DAY1)


PRODUCTS = [_product("A"), _product("B", "25.50", "30.00", "TRUE"), _product("C", active=None),
            _product("D", active="false"), _product("E", cost="n/a", category="Lamp")]


def _order(oid, cid, day="2024-03-01", status="completed", total="100.00", discount="10.00", ship="standard"):
    return (oid, cid, day, status, ship, None, None, "NO", total, discount, "5.123456789", "NOK", "oms", DAY1)


ORDERS = [
    _order("O1", "K1"), _order("O2", "K1", "2024-03-02", "shipped", "50.00", "0.00"),
    _order("O3", "K1", "2024-03-02", "cancelled", "0.00", "0.00"),          # zero amount
    _order("O4", "K2", "2024-03-01", "returned", "70.50", ship="express"),
    _order("O5", "K3", "bad date", "completed", "x", ship="express"),       # nothing parses
    _order("O6", "GONE", "2024-03-05", "shipped", "20.00", "1.00"),         # orphan customer
    _order("O7", None, "2024-03-05", "pending", "33.33"),
] + [_order(f"V{i}", "K5", f"2024-04-0{i}", "completed", "10.01", "0.00", "express") for i in range(1, 6)]

ITEMS = [(f"I{n}", oid, pid, q, "10.00", sub, DAY1) for n, (oid, pid, q, sub) in enumerate([
    ("O1", "A", "3", "30.00"), ("O1", "B", "2", "51.00"), ("O2", "A", "1", "10.00"), ("O4", "A", "2", "20.00"),
    ("O4", "E", "1", "9.99"), ("O5", "B", "one", "25.50"), ("O6", "C", "4", "0.00"), ("O9", "A", "1", "10.00"),
    (None, "A", "1", "10.00"), ("V1", "ZZ", "1", "5.00")])]


def _payment(pid, oid, method="credit_card", status="success", card="1234", at="2024-03-01T12:00:00"):
    return (pid, oid, method, status, "100.00", "NOK", at, "g", card, "pay", DAY1)


PAYMENTS = [_payment("P1", "O1"), _payment("P2", "O2", "paypal", card=None),
            _payment("P3", "O4", status="refunded"), _payment("P4", "O4", status="refunded"),  # same tuple twice
            _payment("P5", "O6"), _payment("P6", "O6", "paypal", "success", None, "2024-03-06T09:00:00")]

SHIPPING = [(f"S{n}", oid, "post", "t", kind, at, "x", "log", DAY1) for n, (oid, kind, at) in enumerate([
    ("O1", "picked_up", "2024-03-01T10:50:00"), ("O1", "delivered", "2024-03-02T06:49:59"),
    ("O1", "delivered", "2024-03-03T00:00:00"), ("O2", "picked_up", "2024-03-02T10:50:00"),
    ("O2", "delivered", "2024-03-02T11:10:00"), ("O4", "delivered", "2024-03-04T00:00:00"),
    ("O4", "returned", "2024-03-09T00:00:00"), ("O6", "picked_up", "2024-03-06T00:00:00"),
    ("O6", "delivered", "2024-03-05T00:00:00"), ("O7", "picked_up", "not a time")])]

ROWS = {"customers": CUSTOMERS, "products": PRODUCTS, "orders": ORDERS, "order_items": ITEMS,
        "payments": PAYMENTS, "shipping_events": SHIPPING}


def raw_tables(spark):
    return {n: spark.createDataFrame(rows, RAW_SCHEMAS[n]) for n, rows in ROWS.items()}
