"""Check SQL for the raw and staging layers, written for DuckDB.

Independent of the Spark code: it derives the same raw text from the star
schema and parses it again with DuckDB's own functions.
"""

from __future__ import annotations

_DELIMS = " \t\n\r[](){}/|\\<>!?@\"^#$&~_,.:;*%+-".replace("'", "''")


def initcap(c: str) -> str:
    chars = f"string_split(lower({c}), '')"
    return (f"array_to_string(list_transform({chars}, lambda ch, i: CASE WHEN i = 1 OR "
            f"contains('{_DELIMS}', {chars}[i - 1]) THEN upper(ch) ELSE ch END), '')")


def numeric(c: str, digits: int = 4) -> str:
    return f"CASE WHEN regexp_full_match({c}, '-?[0-9]+([.][0-9]+)?') THEN CAST({c} AS DECIMAL(18,{digits})) END"


def integer(c: str) -> str:
    return f"CASE WHEN regexp_full_match({c}, '-?[0-9]+') THEN CAST({c} AS BIGINT) END"


def day(c: str) -> str:
    return f"CAST(try_strptime({c}, '%Y-%m-%d') AS DATE)"


def instant(c: str) -> str:
    return f"try_strptime({c}, '%Y-%m-%dT%H:%M:%S')"


def half_up(units: str, n: str, unit_digits: int, digits: int) -> str:
    """Exact mean of integer-coded amounts, rounded half up (amounts >= 0), as DOUBLE."""
    scale = 10 ** (digits - unit_digits) if digits >= unit_digits else None
    if scale is not None:
        num, den = f"(CAST({units} AS HUGEINT) * {scale})", f"({n})"
    else:
        num, den = f"CAST({units} AS HUGEINT)", f"(({n}) * {10 ** (unit_digits - digits)})"
    return f"(CASE WHEN ({n}) > 0 THEN CAST((2 * {num} + {den}) // (2 * {den}) AS DOUBLE) / {float(10 ** digits)} END)"


_STATUS = """CASE WHEN o_orderstatus = 'F' THEN 'completed' WHEN o_orderstatus = 'O' THEN 'shipped'
 WHEN o_orderpriority = '1-URGENT' THEN 'cancelled' WHEN o_orderpriority = '2-HIGH' THEN 'returned' ELSE 'pending' END"""
_URGENT = "o_orderpriority IN ('1-URGENT', '2-HIGH')"

RAW = {
    "customers": """SELECT 'C' || c_custkey AS customer_id,
 concat_ws('-', lower(c_mktsegment), lower(r_name)) AS first_name,
 lower(replace(c_name, '#', ' ')) || CASE WHEN v = 1 THEN ' jr' ELSE '' END AS last_name,
 upper(c_mktsegment) || '.' || c_custkey || '@Mail.Example' AS email,
 '+1-555-' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS phone,
 CASE WHEN c_acctbal < 0 THEN 'unknown' ELSE strftime(DATE '1950-01-01' + CAST(c_custkey % 18000 AS INTEGER), '%Y-%m-%d') END AS date_of_birth,
 CASE WHEN c_mktsegment = 'FURNITURE' THEN NULL ELSE 'F' END AS gender,
 c_custkey || ' Main Street' AS address_line1, n_name AS city, 'S' || c_nationkey AS state, r_name AS country,
 lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS postal_code,
 CASE WHEN c_acctbal < 0 THEN 'not recorded' ELSE strftime(DATE '2015-01-01' + CAST(c_custkey % 2000 AS INTEGER), '%Y-%m-%d') || 'T10:30:00' END AS created_at,
 '2024-06-01T14:22:00' AS updated_at, 'crm' AS source_system,
 TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(v AS INTEGER)) AS _ingested_at
 FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
 JOIN (SELECT unnest([0, 1]) AS v) ON v = 0 OR c_mktsegment = 'MACHINERY'""",
    "products": """SELECT 'P' || p_partkey || e AS product_id, p_name AS product_name, p_type AS category,
 split_part(p_name, ' ', 2) AS subcategory, p_brand AS brand,
 CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS VARCHAR) AS unit_price,
 CASE WHEN p_size = 1 THEN 'tbd' ELSE CAST(CAST(p_retailprice AS DECIMAL(18,2)) * CAST(0.6 AS DECIMAL(3,1)) AS VARCHAR) END AS cost_price,
 CAST(p_size AS VARCHAR) AS weight_kg,
 CASE WHEN e = '-OLD' THEN 'false' WHEN p_size >= 45 THEN NULL ELSE 'TRUE' END AS is_active,
 strftime(DATE '2014-01-01' + CAST(p_size AS INTEGER), '%Y-%m-%d') AS created_at, 'catalog' AS source_system,
 TIMESTAMP '2024-01-01 00:00:00' AS _ingested_at
 FROM part JOIN (SELECT unnest(['', '-OLD']) AS e) ON e = '' OR p_type = 'PROMO'""",
    "orders": f"""SELECT 'ORD-' || o_orderkey AS order_id,
 CASE WHEN o_totalprice > 490000 THEN 'GONE' || o_custkey WHEN {_URGENT} THEN 'C' || o_custkey END AS customer_id,
 CASE WHEN o_totalprice < 2000 THEN 'not known' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS order_date,
 {_STATUS} AS order_status, CASE WHEN {_URGENT} THEN 'express' ELSE 'standard' END AS shipping_method,
 CAST(NULL AS VARCHAR) AS shipping_address_city, o_orderpriority AS shipping_address_state, 'US' AS shipping_address_country,
 CASE WHEN o_totalprice < 3000 THEN 'free' ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) END AS total_amount,
 CAST(CAST(o_totalprice AS DECIMAL(15,2)) * CAST(0.05 AS DECIMAL(3,2)) AS VARCHAR) AS discount_amount,
 CAST(CAST(o_totalprice AS DECIMAL(15,2)) * CAST(0.08 AS DECIMAL(3,2)) AS VARCHAR) AS tax_amount,
 'USD' AS currency, 'oms' AS source_system, o_orderdate AS _ingested_at FROM orders""",
    "order_items": """SELECT 'OI-' || l_orderkey || '-' || l_linenumber AS order_item_id, 'ORD-' || l_orderkey AS order_id,
 'P' || l_partkey AS product_id,
 CASE WHEN l_quantity = 50 THEN 'fifty' ELSE CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) END AS quantity,
 CAST(CAST(l_extendedprice AS DECIMAL(15,2)) * CAST(0.02 AS DECIMAL(3,2)) AS VARCHAR) AS unit_price,
 CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) AS subtotal, l_shipdate AS _ingested_at FROM lineitem""",
    "payments": f"""SELECT 'PAY-' || o_orderkey || '-' || part AS payment_id, 'ORD-' || o_orderkey AS order_id,
 CASE WHEN part = 2 OR o_orderpriority = '5-LOW' THEN 'paypal' WHEN {_URGENT} THEN 'credit_card' ELSE 'debit_card' END AS payment_method,
 CASE WHEN {_STATUS} IN ('cancelled', 'returned') THEN 'refunded' WHEN {_STATUS} = 'pending' THEN 'pending' ELSE 'success' END AS payment_status,
 CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS amount, 'USD' AS currency,
 strftime(CAST(o_orderdate AS DATE) + CAST(part AS INTEGER), '%Y-%m-%d') || 'T12:00:00' AS processed_at,
 'ch_' || o_orderkey || '_' || part AS gateway_reference,
 CASE WHEN part = 2 OR o_orderpriority = '5-LOW' THEN NULL ELSE lpad(CAST(o_custkey % 10000 AS VARCHAR), 4, '0') END AS card_last_four,
 'gateway' AS source_system, o_orderdate AS _ingested_at
 FROM orders JOIN (SELECT unnest([1, 2]) AS part) ON part = 1 OR o_totalprice > 400000""",
    "shipping_events": """SELECT 'SE-' || l_orderkey || '-' || l_linenumber || '-' || kind AS event_id, 'ORD-' || l_orderkey AS order_id,
 'carrier' AS carrier, 'T' || l_suppkey AS tracking_number, kind AS event_type,
 strftime(l_shipdate + to_minutes(CAST(50 * CASE kind WHEN 'picked_up' THEN l_linenumber WHEN 'returned' THEN 400 ELSE l_quantity END AS INTEGER)), '%Y-%m-%dT%H:%M:%S') AS event_timestamp,
 'W' || l_suppkey AS location, 'logistics' AS source_system, l_shipdate AS _ingested_at
 FROM lineitem JOIN (SELECT unnest(['picked_up', 'delivered', 'in_transit', 'returned']) AS kind)
 ON kind = 'picked_up' OR (kind = 'delivered' AND l_linestatus = 'F') OR (kind = 'in_transit' AND l_linestatus <> 'F')
 OR (kind = 'returned' AND l_returnflag = 'R')""",
}

_LATEST = """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY _ingested_at DESC) AS rn
 FROM raw_customers) WHERE rn = 1"""

STG = {
    "customers": f"""SELECT customer_id, {initcap('first_name')} AS first_name, {initcap('last_name')} AS last_name,
 lower(email) AS email, phone, {day('date_of_birth')} AS date_of_birth, gender, address_line1, city, state, country,
 postal_code, {instant('created_at')} AS created_at, {instant('updated_at')} AS updated_at, source_system, _ingested_at
 FROM ({_LATEST})""",
    "products": f"""SELECT product_id, product_name, category, subcategory, brand, {numeric('unit_price')} AS unit_price,
 {numeric('cost_price')} AS cost_price, {numeric('weight_kg')} AS weight_kg,
 coalesce(lower(is_active) = 'true', false) AS is_active, {day('created_at')} AS created_at, source_system
 FROM raw_products""",
    "orders": f"""SELECT order_id, customer_id, {day('order_date')} AS order_date, order_status, shipping_method,
 shipping_address_city, shipping_address_state, shipping_address_country, {numeric('total_amount')} AS total_amount,
 {numeric('discount_amount')} AS discount_amount, {numeric('tax_amount')} AS tax_amount, currency, source_system,
 _ingested_at FROM raw_orders""",
    "order_items": f"""SELECT order_item_id, order_id, product_id, {integer('quantity')} AS quantity,
 {numeric('unit_price')} AS unit_price, {numeric('subtotal')} AS subtotal, _ingested_at FROM raw_order_items""",
    "payments": f"""SELECT payment_id, order_id, payment_method, payment_status, {numeric('amount')} AS amount, currency,
 {instant('processed_at')} AS processed_at, gateway_reference, card_last_four, source_system, _ingested_at
 FROM raw_payments""",
    "shipping_events": f"""SELECT event_id, order_id, carrier, tracking_number, event_type,
 {instant('event_timestamp')} AS event_timestamp, location, source_system, _ingested_at FROM raw_shipping_events""",
}

MONEY_COLUMNS = {
    "products": ["unit_price", "cost_price", "weight_kg"], "orders": ["total_amount", "discount_amount", "tax_amount"],
    "order_items": ["unit_price", "subtotal"], "payments": ["amount"],
}


def units(c: str) -> str:
    """Ten-thousandths as an integer, for exact sums."""
    return f"CAST({c} * 10000 AS BIGINT)"


_SUM = f"sum({units('total_amount')})"

MARTS = {
    "customer_360": f"""SELECT c.customer_id, first_name, last_name, email, city, state, country, created_at AS account_created_at,
 CAST(date_diff('day', CAST(created_at AS DATE), DATE '2024-12-31') AS BIGINT) AS account_age_days,
 count(DISTINCT order_id) AS total_orders, coalesce(CAST({_SUM} AS DOUBLE) / 10000, 0) AS lifetime_revenue,
 coalesce({half_up(_SUM, 'count(total_amount)', 4, 9)}, 0) AS avg_order_value,
 {_SUM} AS revenue_units, max(order_date) AS last_order_date, min(order_date) AS first_order_date,
 count(*) FILTER (WHERE order_status = 'completed') AS completed_orders,
 count(*) FILTER (WHERE order_status = 'returned') AS returned_orders,
 count(*) FILTER (WHERE order_status = 'cancelled') AS cancelled_orders,
 CASE WHEN count(DISTINCT order_id) >= 5 THEN 'VIP' WHEN count(DISTINCT order_id) >= 3 THEN 'Regular'
 WHEN count(DISTINCT order_id) >= 1 THEN 'Occasional' ELSE 'Prospect' END AS customer_segment
 FROM stg_customers c LEFT JOIN stg_orders o ON c.customer_id = o.customer_id GROUP BY ALL""",
    "product_performance": f"""SELECT p.product_id, product_name, category, subcategory, brand,
 CAST(p.unit_price AS DOUBLE) AS current_price, CAST(cost_price AS DOUBLE) AS cost_price, is_active,
 CAST(coalesce(sum(quantity), 0) AS BIGINT) AS total_units_sold,
 coalesce(CAST(sum({units('subtotal')}) AS DOUBLE) / 10000, 0) AS total_revenue,
 coalesce(CAST(sum({units('subtotal')}) - sum(quantity * {units('cost_price')}) AS DOUBLE) / 10000, 0) AS gross_margin,
 CASE WHEN sum({units('subtotal')}) <> 0 THEN
 CAST(sum({units('subtotal')}) - sum(quantity * {units('cost_price')}) AS HUGEINT) END AS margin_num,
 CAST(sum({units('subtotal')}) AS HUGEINT) AS margin_den,
 count(DISTINCT oi.order_id) AS order_count, count(DISTINCT o.customer_id) AS unique_buyers
 FROM stg_products p LEFT JOIN stg_order_items oi ON p.product_id = oi.product_id
 LEFT JOIN stg_orders o ON oi.order_id = o.order_id GROUP BY ALL""",
    "revenue_daily": f"""SELECT order_date, year(order_date) AS year, month(order_date) AS month, dayofweek(order_date) + 1 AS day_of_week,
 count(DISTINCT order_id) AS order_count, CAST({_SUM} AS DOUBLE) / 10000 AS gross_revenue,
 CAST(sum({units('discount_amount')}) AS DOUBLE) / 10000 AS total_discounts,
 CAST(sum({units('tax_amount')}) AS DOUBLE) / 10000 AS total_tax,
 CAST({_SUM} - sum({units('discount_amount')}) AS DOUBLE) / 10000 AS net_revenue,
 {_SUM} - sum({units('discount_amount')}) AS net_units,
 {half_up(_SUM, 'count(total_amount)', 4, 9)} AS avg_order_value, count(DISTINCT customer_id) AS unique_customers
 FROM stg_orders WHERE order_status IN ('completed', 'shipped') GROUP BY ALL""",
    "order_fulfillment": """SELECT o.order_id, customer_id, order_date, order_status, shipping_method,
 CAST(total_amount AS DOUBLE) AS total_amount, payment_method, payment_status, processed_at AS payment_processed_at,
 min(CASE WHEN event_type = 'picked_up' THEN event_timestamp END) AS picked_up_at,
 min(CASE WHEN event_type = 'delivered' THEN event_timestamp END) AS delivered_at,
 min(CASE WHEN event_type = 'returned' THEN event_timestamp END) AS returned_at,
 date_sub('hour', min(CASE WHEN event_type = 'picked_up' THEN event_timestamp END),
 min(CASE WHEN event_type = 'delivered' THEN event_timestamp END)) AS delivery_hours
 FROM stg_orders o LEFT JOIN stg_payments p ON o.order_id = p.order_id
 LEFT JOIN stg_shipping_events e ON o.order_id = e.order_id GROUP BY ALL""",
}

# Ratio to 9 digits, half away from zero, from the exact integer sums.
MARGIN_PCT = """CASE WHEN margin_num IS NOT NULL AND margin_den <> 0 THEN CAST(sign(margin_num) *
 ((2 * abs(margin_num) * 1000000000 + margin_den) // (2 * margin_den)) AS DOUBLE) / 1000000000.0 END"""

_NEEDS = {
    "customer_360": ["customers", "orders"], "product_performance": ["products", "order_items", "orders"],
    "revenue_daily": ["orders"], "order_fulfillment": ["orders", "payments", "shipping_events"],
}


def with_layers(body: str, *names: str) -> str:
    """``body`` behind the CTEs of the named raw tables (``raw:x``), staged tables or marts."""
    raws, stgs, marts = [], [], []
    for n in names:
        if n in MARTS:
            marts.append(n)
            stgs += _NEEDS[n]
        elif n.startswith("raw:"):
            raws.append(n[4:])
        else:
            stgs.append(n)
    stgs = list(dict.fromkeys(stgs))
    raws = list(dict.fromkeys(raws + stgs))
    ctes = ([f"raw_{n} AS ({RAW[n]})" for n in raws] + [f"stg_{n} AS ({STG[n]})" for n in stgs]
            + [f"{n} AS ({MARTS[n]})" for n in marts])
    return "WITH " + ",\n".join(ctes) + "\n" + body
