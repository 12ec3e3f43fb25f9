"""D1-D22, G1-G6 and J4-J8 over the star-schema tables."""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.display import last_two_parts
from ..operators import catalog, constraints, inventory, lineage, pii, predicates, profile, skew, usage
from ..operators.pipeline_lineage import column_edges, table_edges
from ..operators.specs import TableSpec
from ..sources import retail
from ..sources.retail import table
from .layers_sql import MARGIN_PCT, with_layers
from .pipeline import mart, staged
from .registry import query

STAR = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
        "pages", "benchmark", "labels", "conversations"]

# Column kinds of the star schema, for the check SQL only.
_N, _S, _T = "number", "text", "time"
STAR_COLUMNS = {
    "region": {"r_regionkey": _N, "r_name": _S},
    "nation": {"n_nationkey": _N, "n_name": _S, "n_regionkey": _N},
    "customer": {"c_custkey": _N, "c_name": _S, "c_nationkey": _N, "c_acctbal": _N, "c_mktsegment": _S},
    "supplier": {"s_suppkey": _N, "s_name": _S, "s_nationkey": _N, "s_acctbal": _N},
    "part": {"p_partkey": _N, "p_name": _S, "p_brand": _S, "p_type": _S, "p_size": _N, "p_retailprice": _N},
    "orders": {"o_orderkey": _N, "o_custkey": _N, "o_orderstatus": _S, "o_totalprice": _N, "o_orderdate": _T,
               "o_orderpriority": _S},
    "lineitem": {"l_orderkey": _N, "l_partkey": _N, "l_suppkey": _N, "l_linenumber": _N, "l_quantity": _N,
                 "l_extendedprice": _N, "l_discount": _N, "l_tax": _N, "l_returnflag": _S, "l_linestatus": _S,
                 "l_shipdate": _T},
    "events": {"event_id": _N, "ts": _T, "user_id": _N, "event_type": _S, "value": _N, "props": _S},
    "documents": {"doc_id": _N, "text": _S, "lang": _S, "source": _S, "n_chars": _N},
    "embeddings": {"vec_id": _N, "embedding": "list", "label": _N},
    "pages": {"page_id": _N, "url": _S, "html": _S},
    "benchmark": {"item_id": _N, "text": _S},
    "labels": {"doc_id": _N, "quality": _N, "toxic": _N},
    "conversations": {"conv_id": _N, "turn": _N, "role": _S, "text": _S},
}


def profile_sql(dataset: str, name: str, columns: dict[str, str], source: str | None = None) -> str:
    """One SELECT per column, the form the profiler replaces."""
    parts = []
    for i, (c, kind) in enumerate(columns.items()):
        q = f'"{c}"'
        d = f"CAST({q} AS DOUBLE)"
        number = ([f"min({d})", f"max({d})", f"round(avg({d}), 4)", f"round(stddev_samp({d}), 4)"]
                  if kind == _N else ["CAST(NULL AS DOUBLE)"] * 4)
        lengths = ([f"min(length({q}))", f"max(length({q}))", f"round(avg(length({q})), 1)"]
                   if kind == _S else ["CAST(NULL AS BIGINT)", "CAST(NULL AS BIGINT)", "CAST(NULL AS DOUBLE)"])
        parts.append(f"""SELECT '{dataset}' AS dataset_id, '{name}' AS table_name, CAST({i + 1} AS BIGINT) AS ordinal_position,
 '{c}' AS column_name, count(*) AS total_rows, count(*) - count({q}) AS null_count,
 round((count(*) - count({q})) / count(*) * 100, 2) AS null_pct, count(DISTINCT {q}) AS distinct_count,
 round(count(DISTINCT {q}) / count(*) * 100, 2) AS uniqueness_pct,
 {number[0]} AS min_number, {number[1]} AS max_number, {number[2]} AS mean, {number[3]} AS stddev,
 {lengths[0]} AS min_length, {lengths[1]} AS max_length, {lengths[2]} AS avg_length, 'ok' AS status
 FROM {source or name}""")
    return "\nUNION ALL ".join(parts)


def _spec(spark, sf_dir, name, **kw) -> TableSpec:
    return TableSpec("star", name, table(spark, sf_dir, name), **kw)


def _profile(spark, sf_dir, *names) -> DataFrame:
    return profile.profile_tables([_spec(spark, sf_dir, n) for n in names])


_PROFILED = STAR


@query("D1_column_profile", "\nUNION ALL ".join(profile_sql("star", n, STAR_COLUMNS[n]) for n in _PROFILED))
def column_profile(spark, sf_dir):
    # Text forms of times and type names differ between engines; tests cover them.
    return _profile(spark, sf_dir, *_PROFILED).drop("data_type", "min_text", "max_text")


# The staged tables, typed from damaged text, with NULLs in every kind of column.
_STAGED_COLUMNS = {
    "customers": {"customer_id": _S, "first_name": _S, "last_name": _S, "email": _S, "phone": _S, "date_of_birth": _T, "gender": _S,
                  "address_line1": _S, "city": _S, "state": _S, "country": _S, "postal_code": _S, "created_at": _T, "updated_at": _T,
                  "source_system": _S, "_ingested_at": _T},
    "products": {"product_id": _S, "product_name": _S, "category": _S, "subcategory": _S, "brand": _S, "unit_price": _N, "cost_price": _N,
                 "weight_kg": _N, "is_active": "flag", "created_at": _T, "source_system": _S},
    "orders": {"order_id": _S, "customer_id": _S, "order_date": _T, "order_status": _S, "shipping_method": _S, "shipping_address_city": _S,
               "shipping_address_state": _S, "shipping_address_country": _S, "total_amount": _N, "discount_amount": _N, "tax_amount": _N,
               "currency": _S, "source_system": _S, "_ingested_at": _T},
    "order_items": {"order_item_id": _S, "order_id": _S, "product_id": _S, "quantity": _N, "unit_price": _N, "subtotal": _N, "_ingested_at": _T},
    "payments": {"payment_id": _S, "order_id": _S, "payment_method": _S, "payment_status": _S, "amount": _N, "currency": _S,
                 "processed_at": _T, "gateway_reference": _S, "card_last_four": _S, "source_system": _S, "_ingested_at": _T},
    "shipping_events": {"event_id": _S, "order_id": _S, "carrier": _S, "tracking_number": _S, "event_type": _S, "event_timestamp": _T,
                        "location": _S, "source_system": _S, "_ingested_at": _T},
}


def _staged_profile(spark, sf_dir, figures: bool = True) -> DataFrame:
    return profile.profile_tables([TableSpec("staging", n, staged(spark, sf_dir, n)) for n in _STAGED_COLUMNS], figures=figures)


_STAGED_PROFILE_SQL = "\nUNION ALL ".join(
    profile_sql("staging", n, cols, f"stg_{n}") for n, cols in _STAGED_COLUMNS.items())

query("D1_column_profile_staged", with_layers(_STAGED_PROFILE_SQL, *_STAGED_COLUMNS))(
    lambda spark, sf_dir: _staged_profile(spark, sf_dir).drop("data_type", "min_text", "max_text"))


@query("D2_profile_skip_rules", f"""
SELECT 'star' AS dataset_id, 'customer' AS table_name, 'ok' AS status, count(*) AS columns
 FROM ({profile_sql('star', 'customer', STAR_COLUMNS['customer'])})
UNION ALL SELECT 'star', 'v_orders', '{profile.VIEW_NOTE}', 0
UNION ALL SELECT 'star', 'v_customer', '{profile.VIEW_NOTE}', 0""")
def profile_skip_rules(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    found = profile.profile_tables([
        _spec(spark, sf_dir, "customer"),
        TableSpec("star", "v_orders", orders, kind="VIEW"),
        TableSpec("star", "v_customer", table(spark, sf_dir, "customer"), kind="VIEW"),
        TableSpec("star", "empty_orders", orders.where(F.col("o_totalprice") < 0))])
    return found.groupBy("dataset_id", "table_name", "status").agg(F.count("column_name").alias("columns"))


_QUALITY_SQL = f"""SELECT dataset_id || '.' || table_name AS "table", dataset_id, table_name, column_name,
 coalesce(null_pct, 0) AS null_pct, null_count, uniqueness_pct AS distinct_pct, distinct_count, total_rows
 FROM ({_STAGED_PROFILE_SQL})"""


def _quality(spark, sf_dir) -> DataFrame:
    return profile.quality_rows(_staged_profile(spark, sf_dir, figures=False)).select(
        "table", "dataset_id", "table_name", "column_name", "null_pct", "null_count", "distinct_pct",
        "distinct_count", "total_rows")


query("D3_quality_rows", with_layers(_QUALITY_SQL, *_STAGED_COLUMNS))(_quality)

query("D4_quality_summary", with_layers(f"""
SELECT count(*) AS total, count(*) FILTER (WHERE null_pct > 0) AS with_nulls,
 count(*) FILTER (WHERE distinct_pct > 0 AND distinct_pct < 50) AS low_distinct,
 count(*) FILTER (WHERE null_pct > 50) AS high_null FROM ({_QUALITY_SQL})""", *_STAGED_COLUMNS))(
    lambda spark, sf_dir: profile.quality_summary(_quality(spark, sf_dir)))

query("P11_quality_filter", with_layers(
    f"SELECT * FROM ({_QUALITY_SQL}) WHERE null_pct > 0 OR distinct_pct < 50", *_STAGED_COLUMNS))(
    lambda spark, sf_dir: predicates.quality_filter(_quality(spark, sf_dir), "issues"))

query("P11_quality_filter_nulls", with_layers(
    f"SELECT * FROM ({_QUALITY_SQL}) WHERE null_pct > 0", *_STAGED_COLUMNS))(
    lambda spark, sf_dir: predicates.quality_filter(_quality(spark, sf_dir), "nulls"))


# --- inventories --------------------------------------------------------------------------------

def _inventory(spark, sf_dir) -> DataFrame:
    specs = [_spec(spark, sf_dir, n, labels={"pii": "true"} if n == "customer" else {}) for n in STAR]
    return inventory.table_inventory(specs + [_spec(spark, sf_dir, "orders", kind="VIEW")])


_STAR_WIDTH = dict(region=2, nation=3, customer=5, supplier=4, part=6, orders=6, lineitem=11, events=6,
                   documents=5, embeddings=3, pages=3, benchmark=2, labels=3, conversations=4)
_INVENTORY_SQL = "\nUNION ALL ".join(
    [f"SELECT 'star' AS dataset_id, '{n}' AS table_name, 'TABLE' AS table_type, count(*) AS num_rows, "
     f"CAST({w} AS BIGINT) AS column_count FROM {n}" for n, w in _STAR_WIDTH.items()]
    + ["SELECT 'star', 'orders', 'VIEW', 0, 6"])

query("D5_table_inventory", _INVENTORY_SQL)(lambda spark, sf_dir: _inventory(spark, sf_dir).select(
    "dataset_id", "table_name", "table_type", "num_rows", "column_count"))

# Sizes are facts of the stored files, which SQL does not see.
query("D5_table_sizes")(lambda spark, sf_dir: _inventory(spark, sf_dir).select(
    "table_name", "num_rows", "num_bytes", "size_mb"))

query("D6_overview", f"""
SELECT CAST(sum(column_count) AS BIGINT) AS total_columns, CAST(sum(num_rows) AS BIGINT) AS total_rows,
 count(*) FILTER (WHERE table_type = 'VIEW') AS views, count(*) FILTER (WHERE table_type <> 'VIEW') AS tables,
 (SELECT count(*) FROM events) AS jobs, (SELECT count(*) FROM labels) AS labels FROM ({_INVENTORY_SQL})""")(
    lambda spark, sf_dir: inventory.overview(
        _inventory(spark, sf_dir), jobs=table(spark, sf_dir, "events"), labels=table(spark, sf_dir, "labels")
    ).drop("total_bytes"))

_MART_COLUMNS = {
    "customer_360": ["customer_id", "first_name", "last_name", "email", "city", "state", "country", "account_created_at", "account_age_days",
                     "total_orders", "lifetime_revenue", "avg_order_value", "last_order_date", "first_order_date", "completed_orders",
                     "returned_orders", "cancelled_orders", "customer_segment"],
    "product_performance": ["product_id", "product_name", "category", "subcategory", "brand", "current_price", "cost_price", "is_active",
                            "total_units_sold", "total_revenue", "gross_margin", "margin_pct", "order_count", "unique_buyers"],
    "revenue_daily": ["order_date", "year", "month", "day_of_week", "order_count", "gross_revenue", "total_discounts", "total_tax",
                      "net_revenue", "avg_order_value", "unique_customers"],
    "order_fulfillment": ["order_id", "customer_id", "order_date", "order_status", "shipping_method", "total_amount", "payment_method",
                          "payment_status", "payment_processed_at", "picked_up_at", "delivered_at", "returned_at", "delivery_hours"],
}


def _layer_specs(spark, sf_dir) -> list[TableSpec]:
    """The raw, staged and mart tables."""
    specs = [TableSpec("raw_ecommerce", n, retail.raw(spark, sf_dir, n)) for n in _STAGED_COLUMNS]
    specs += [TableSpec("staging_ecommerce", f"stg_{n}", staged(spark, sf_dir, n)) for n in _STAGED_COLUMNS]
    return specs + [TableSpec("analytics_ecommerce", n, mart(spark, sf_dir, n)) for n in _MART_COLUMNS]


_COLUMN_KEY = ["dataset_id", "table_name", "column_name"]


def _with_rows(columns: DataFrame, specs: list[TableSpec]) -> DataFrame:
    """Columns of these tables with their filled rows."""
    return columns.join(inventory.filled_rows(specs), _COLUMN_KEY)


def _raw_columns_with_rows(spark, sf_dir) -> DataFrame:
    """Every column of the raw, staged and mart tables with its filled rows."""
    specs = _layer_specs(spark, sf_dir)
    return _with_rows(inventory.column_inventory(spark, specs), specs)


def _raw_columns_sql() -> str:
    from ..types import RAW_SCHEMAS
    tables = [("raw_ecommerce", n, f"raw_{n}", RAW_SCHEMAS[n].names) for n in _STAGED_COLUMNS]
    tables += [("staging_ecommerce", f"stg_{n}", f"stg_{n}", list(c)) for n, c in _STAGED_COLUMNS.items()]
    tables += [("analytics_ecommerce", n, n, c) for n, c in _MART_COLUMNS.items()]
    return "\nUNION ALL ".join(
        f"SELECT '{d}' AS dataset_id, '{t}' AS table_name, '{c}' AS column_name, "
        f"CAST({i + 1} AS BIGINT) AS ordinal_position, count({MARGIN_PCT if c == 'margin_pct' else chr(34) + c + chr(34)}) AS present_rows FROM {source}"
        for d, t, source, columns in tables for i, c in enumerate(columns))


_RAW_LAYERS = [f"raw:{n}" for n in _STAGED_COLUMNS] + [*_STAGED_COLUMNS, *_MART_COLUMNS]

query("D7_column_inventory", with_layers(_raw_columns_sql(), *_RAW_LAYERS))(
    lambda spark, sf_dir: _raw_columns_with_rows(spark, sf_dir).select(
        "dataset_id", "table_name", "column_name", "ordinal_position", "present_rows"))


@query("D8_field_paths", """
SELECT 'star' AS dataset_id, 'people' AS table_name, split_part(p, '.', 1) AS column_name, p AS field_path, total_rows,
 CASE p WHEN 'address.region' THEN with_region WHEN 'address.zone' THEN with_zone WHEN 'tags' THEN with_tags
 ELSE total_rows END AS present_rows FROM
 (SELECT count(*) AS total_rows, count(r_name) AS with_region, count(*) FILTER (WHERE c_acctbal >= 0) AS with_zone,
 count(*) FILTER (WHERE c_mktsegment <> 'MACHINERY') AS with_tags
 FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey),
 (SELECT unnest(['c_custkey', 'address', 'address.nation', 'address.region', 'address.zone', 'tags', 'tags.name']) AS p)
 WHERE p <> 'tags.name'
UNION ALL SELECT 'star', 'people', 'tags', 'tags.name', count(*), count(*) FILTER (WHERE c_mktsegment NOT IN ('MACHINERY', 'FURNITURE')) FROM customer
""")
def field_paths(spark, sf_dir):
    c, n, r = (table(spark, sf_dir, t) for t in ("customer", "nation", "region"))
    segment = F.col("c_mktsegment")
    people = (c.join(n, c.c_nationkey == n.n_nationkey, "left").join(r, n.n_regionkey == r.r_regionkey, "left")
              .select("c_custkey", F.struct(
                  F.col("n_name").alias("nation"), F.col("r_name").alias("region"),
                  F.when(F.col("c_acctbal") >= 0, F.col("c_nationkey")).alias("zone")).alias("address"),
                  F.when(segment != "MACHINERY", F.array(F.struct(
                      F.when(segment != "FURNITURE", segment).alias("name")))).alias("tags")))
    return inventory.field_paths(TableSpec("star", "people", people)).drop("data_type")


query("D8_json_paths", """
SELECT 'props.' || k AS field_path, count(*) AS present_rows, count(json_extract_string(props, '$.' || k)) AS non_null_rows
 FROM (SELECT props, unnest(json_keys(props)) AS k FROM events) GROUP BY k""")(
    lambda spark, sf_dir: inventory.json_paths(table(spark, sf_dir, "events"), "props"))


def _partitions(spark, sf_dir) -> DataFrame:
    return inventory.partition_stats(table(spark, sf_dir, "orders"), F.date_format("o_orderdate", "yyyyMM"))


_PARTITION_SQL = "SELECT strftime(o_orderdate, '%Y%m') AS partition_id, count(*) AS total_rows FROM orders GROUP BY 1"

query("D9_partition_stats", _PARTITION_SQL)(
    lambda spark, sf_dir: _partitions(spark, sf_dir).select("partition_id", "total_rows"))

query("D10_storage_stats", f"""
SELECT CAST(sum(total_rows) AS BIGINT) AS total_rows, count(*) AS total_partitions FROM ({_PARTITION_SQL})""")(
    lambda spark, sf_dir: inventory.storage_stats(_partitions(spark, sf_dir)).select(
        "total_rows", "total_partitions"))


# --- options, labels, access --------------------------------------------------------------------
# Each user of the event stream stands for a table and each event for a change of one of its options.

def _option_log(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.lit("star").alias("dataset_id"), F.concat(F.lit("t"), F.col("user_id")).alias("table_name"),
        F.col("event_type").alias("option_name"), F.col("props").alias("option_value"),
        F.col("ts").alias("applied_at"), F.col("event_id").alias("sequence"))


_CURRENT_SQL = """SELECT 'star' AS dataset_id, 't' || user_id AS table_name, event_type AS option_name, props AS option_value,
 ts AS applied_at, event_id AS sequence FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type
 ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1"""

query("D12_current_options", _CURRENT_SQL)(
    lambda spark, sf_dir: catalog.current_options(_option_log(spark, sf_dir), "applied_at", "sequence"))

query("D11_options_long", """
SELECT 'star' AS dataset_id, c_mktsegment AS table_name, o AS option_name,
 CASE o WHEN 'owner' THEN c_name ELSE CAST(c_nationkey AS VARCHAR) END AS option_value
 FROM customer, (SELECT unnest(['owner', 'nation']) AS o)""")(
    lambda spark, sf_dir: catalog.options_long(table(spark, sf_dir, "customer").select(
        F.lit("star").alias("dataset_id"), F.col("c_mktsegment").alias("table_name"),
        F.create_map(F.lit("owner"), F.col("c_name"), F.lit("nation"), F.col("c_nationkey").cast("string")).alias("options"))))


def _grouped_options(spark, sf_dir) -> DataFrame:
    current = catalog.current_options(_option_log(spark, sf_dir), "applied_at", "sequence")
    return catalog.options_grouped(current, "sequence")


_GROUPED_SQL = f"""SELECT dataset_id || '.' || table_name AS "table", row_number() OVER (PARTITION BY dataset_id, table_name
 ORDER BY sequence, option_name, option_value) - 1 AS position, option_name, option_value FROM ({_CURRENT_SQL})"""

query("D11_options_grouped", _GROUPED_SQL)(_grouped_options)

query("P9_search_nested", f"""SELECT * FROM ({_CURRENT_SQL}) o WHERE contains(lower(dataset_id || '.' || table_name), 'err')
 OR EXISTS (SELECT 1 FROM events e WHERE 't' || e.user_id = o.table_name AND contains(e.event_type, 'err'))""")(
    lambda spark, sf_dir: catalog.search_options(
        catalog.current_options(_option_log(spark, sf_dir), "applied_at", "sequence"), "ERR"))


@query("P9_search_large_groups", """
WITH o AS (SELECT 'star' AS dataset_id, 'p' || l_partkey % 7 AS table_name, 'o' || l_orderkey || '-' || l_linenumber AS option_name,
 l_shipdate AS option_value, l_orderkey, l_partkey FROM lineitem)
SELECT dataset_id, table_name, option_name, strftime(option_value, '%Y-%m-%d') AS option_value FROM o WHERE table_name IN
 (SELECT table_name FROM o WHERE l_orderkey < 100 AND l_partkey % 7 < 3)""")
def search_large_groups(spark, sf_dir):
    """Seven tables with thousands of options each: a hit brings the whole group."""
    needle = (F.col("l_orderkey") < 100) & (F.col("l_partkey") % 7 < 3)
    options = table(spark, sf_dir, "lineitem").select(
        F.lit("star").alias("dataset_id"), F.concat(F.lit("p"), F.col("l_partkey") % 7).alias("table_name"),
        F.concat(F.when(needle, "needle:").otherwise(""), F.lit("o"), "l_orderkey", F.lit("-"), "l_linenumber").alias("option_name"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("option_value"))
    found = catalog.search_options(options, "NEEDLE")
    return found.withColumn("option_name", F.regexp_replace("option_name", "^needle:", ""))


query("A13_collect_members", """
SELECT o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey, o_orderstatus) - 1 AS position, o_orderkey, o_orderstatus
 FROM orders""")(
    lambda spark, sf_dir: skew.collect_members(
        table(spark, sf_dir, "orders"), "o_custkey", "o_orderkey", ["o_orderkey", "o_orderstatus"]))


def _datasets(spark, sf_dir) -> DataFrame:
    """A dataset per customer, with the customer's nation and region as access entries."""
    c, n = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    entry = lambda role, kind, who: F.struct(
        F.lit(role).alias("role"), F.lit(kind).alias("entity_type"), who.alias("entity_id"))
    return c.join(n, c.c_nationkey == n.n_nationkey, "left").select(
        F.col("c_name").alias("dataset_id"), F.array(
            entry("READER", "userByEmail", F.concat(F.col("c_custkey"), F.lit("@example.com"))),
            entry("WRITER", "groupByEmail", F.col("c_mktsegment")),
            entry(None, "view", F.col("n_name"))).alias("access_entries"))


_ACCESS_SQL = """SELECT c_name AS dataset_id, role, entity_type,
 CASE entity_type WHEN 'userByEmail' THEN c_custkey || '@example.com' WHEN 'groupByEmail' THEN c_mktsegment ELSE n_name END AS entity_id
 FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey,
 (VALUES ('READER', 'userByEmail'), ('WRITER', 'groupByEmail'), (NULL, 'view')) AS e(role, entity_type)"""

query("D17_access_rows", _ACCESS_SQL)(lambda spark, sf_dir: catalog.access_rows(_datasets(spark, sf_dir)))
query("D17_authorized_views",
      f"SELECT dataset_id, entity_id AS authorized_view FROM ({_ACCESS_SQL}) WHERE entity_type = 'view'")(
    lambda spark, sf_dir: catalog.authorized_views(catalog.access_rows(_datasets(spark, sf_dir))))


# --- keys ---------------------------------------------------------------------------------------

def _pk_sql(name: str, source: str, *key: str) -> str:
    k = ", ".join(key)
    some = " AND ".join(f"{c} IS NOT NULL" for c in key)
    text = "concat_ws(',', " + k + ")"
    return f"""SELECT '{name}' AS constraint_name, 'PRIMARY KEY' AS constraint_type, CAST(sum(n) AS BIGINT) AS checked_rows,
 CAST(coalesce(sum(n) FILTER (WHERE NOT ({some})), 0) AS BIGINT) AS null_key_rows,
 count(*) FILTER (WHERE {some} AND n > 1) AS violating_keys,
 CAST(coalesce(sum(n) FILTER (WHERE {some} AND n > 1), 0) AS BIGINT) AS violating_rows,
 min({text}) FILTER (WHERE {some} AND n > 1) AS sample_key FROM (SELECT {k}, count(*) AS n FROM {source} GROUP BY {k})"""


def _fk_sql(name: str, child: str, ck: str, parent: str, pk: str) -> str:
    orphan = f"{ck} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{pk} = c.{ck})"
    return f"""SELECT '{name}', 'FOREIGN KEY', count(*), count(*) - count({ck}), count(DISTINCT CASE WHEN {orphan} THEN {ck} END),
 count(*) FILTER (WHERE {orphan}), min(CASE WHEN {orphan} THEN CAST({ck} AS VARCHAR) END) FROM {child} c"""


# Declared keys: (name, table, key) and (name, child, key, parent, key).
_PRIMARY_KEYS = [
    ("pk_raw_customers", "raw_customers", "customer_id"), ("pk_raw_products", "raw_products", "product_id"),
    ("pk_raw_orders", "raw_orders", "order_id"), ("pk_raw_payments", "raw_payments", "payment_id"),
    ("pk_stg_customers", "stg_customers", "customer_id"), ("pk_stg_products", "stg_products", "product_id"),
    ("pk_stg_orders", "stg_orders", "order_id"), ("pk_customer_360", "customer_360", "customer_id"),
]
_FOREIGN_KEYS = [
    ("fk_orders_customer", "raw_orders", "customer_id", "raw_customers", "customer_id"),
    ("fk_order_items_order", "raw_order_items", "order_id", "raw_orders", "order_id"),
    ("fk_order_items_product", "raw_order_items", "product_id", "raw_products", "product_id"),
    ("fk_payments_order", "raw_payments", "order_id", "raw_orders", "order_id"),
    ("fk_stg_orders_customer", "stg_orders", "customer_id", "stg_customers", "customer_id"),
]
_KEYED_LAYERS = ["raw:customers", "raw:products", "raw:orders", "raw:payments", "raw:order_items", "customers", "products", "orders", "customer_360"]


@query("D13_constraint_report", with_layers("\nUNION ALL ".join(
    [_pk_sql("pk_lineitem", "lineitem", "l_orderkey", "l_linenumber")] + [_pk_sql(*k) for k in _PRIMARY_KEYS]
    + [_fk_sql(*k) for k in _FOREIGN_KEYS]), *_KEYED_LAYERS))
def constraint_report(spark, sf_dir):
    tables = {f"raw_{n}": retail.raw(spark, sf_dir, n) for n in ("customers", "products", "orders", "payments", "order_items")}
    tables |= {f"stg_{n}": staged(spark, sf_dir, n) for n in ("customers", "products", "orders")}
    tables["customer_360"] = mart(spark, sf_dir, "customer_360")
    return constraints.constraint_report(
        constraints.primary_key_check(table(spark, sf_dir, "lineitem"), "pk_lineitem", "l_orderkey", "l_linenumber"),
        *[constraints.primary_key_check(tables[t], name, key) for name, t, key in _PRIMARY_KEYS],
        *[constraints.foreign_key_check(tables[c], name, ck, tables[p], pk) for name, c, ck, p, pk in _FOREIGN_KEYS])


query("J7_foreign_key_orphans", with_layers("""
SELECT customer_id AS key, count(*) AS n FROM raw_orders o WHERE customer_id IS NOT NULL
 AND NOT EXISTS (SELECT 1 FROM raw_customers c WHERE c.customer_id = o.customer_id) GROUP BY 1""",
                                            "raw:orders", "raw:customers"))(
    lambda spark, sf_dir: constraints.foreign_key_orphans(
        retail.raw(spark, sf_dir, "orders"), "customer_id", retail.raw(spark, sf_dir, "customers"), "customer_id"))


# --- personal data ------------------------------------------------------------------------------

_KEYWORD_ROWS = ", ".join(f"({i}, '{k}', '{c}')" for i, (k, c) in enumerate(pii.PII_KEYWORDS))
_PII_SQL = f"""SELECT dataset_id, table_name, column_name, present_rows, cls AS pii_classification,
 CASE WHEN lower(column_name) = kw THEN 'high' ELSE 'medium' END AS confidence FROM (
 SELECT *, row_number() OVER (PARTITION BY dataset_id, table_name, column_name ORDER BY ord) AS rn
 FROM ({_raw_columns_sql()}), (VALUES {_KEYWORD_ROWS}) AS k(ord, kw, cls)
 WHERE contains(lower(column_name), kw)) WHERE rn = 1"""


def _pii_names(spark, specs: list[TableSpec]) -> DataFrame:
    """Names alone decide the class, so this reads schemas only."""
    return pii.classify_columns(inventory.column_inventory(spark, specs))


def _pii(spark, sf_dir) -> DataFrame:
    """The classified columns with their filled rows; the rest of the columns is not counted."""
    specs = _layer_specs(spark, sf_dir)
    found = _pii_names(spark, specs)
    hits: dict[tuple[str, str], list[str]] = {}
    for r in found.select(*_COLUMN_KEY).collect():  # a row per column of a schema
        hits.setdefault((r.dataset_id, r.table_name), []).append(r.column_name)
    return _with_rows(found, [replace(s, df=s.df.select(*hits[s.dataset, s.name])) for s in specs if (s.dataset, s.name) in hits])


def _flagged(spark, sf_dir) -> DataFrame:
    specs = _layer_specs(spark, sf_dir)
    return pii.flag_columns(_with_rows(inventory.column_inventory(spark, specs), specs), _pii_names(spark, specs))


_PII_COLUMNS = ["dataset_id", "table_name", "column_name", "present_rows", "pii_classification", "confidence"]

for _id in ("D14_pii_classification", "J8_rule_join"):
    query(_id, with_layers(_PII_SQL, *_RAW_LAYERS))(
        lambda spark, sf_dir: _pii(spark, sf_dir).select(*_PII_COLUMNS))

for _id in ("D15_pii_rollup", "A14_distinct_in_group"):
    query(_id, with_layers(f"""
SELECT pii_classification, count(*) AS column_count, count(DISTINCT table_name) AS table_count
 FROM ({_PII_SQL}) GROUP BY 1""", *_RAW_LAYERS))(lambda spark, sf_dir: pii.pii_rollup(_pii(spark, sf_dir)))

query("J4_membership_flag", with_layers(f"""
SELECT c.dataset_id, c.table_name, c.column_name, c.present_rows, p.column_name IS NOT NULL AS pii
 FROM ({_raw_columns_sql()}) c LEFT JOIN ({_PII_SQL}) p
 ON c.dataset_id = p.dataset_id AND c.table_name = p.table_name AND c.column_name = p.column_name""", *_RAW_LAYERS))(
    lambda spark, sf_dir: _flagged(spark, sf_dir).select(
        "dataset_id", "table_name", "column_name", "present_rows", "pii"))


def _customer_tables(spark, sf_dir) -> DataFrame:
    """One table per customer; a label marks the ones of a segment."""
    c = table(spark, sf_dir, "customer")
    return c.select(F.lit("star").alias("dataset_id"), F.col("c_name").alias("table_name"),
                    F.create_map(F.lit("pii"), F.when(F.col("c_mktsegment") == "BUILDING", "true").otherwise("false")).alias("labels"))


@query("D16_pii_tables", """
SELECT 'star' AS dataset_id, c_name AS table_name,
 c_mktsegment = 'BUILDING' OR EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '5-LOW'
 AND o_orderstatus = 'P') AS pii FROM customer""")
def pii_tables(spark, sf_dir):
    o, c = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    found = o.where((F.col("o_orderpriority") == "5-LOW") & (F.col("o_orderstatus") == "P")).join(
        c, o.o_custkey == c.c_custkey).select(
        F.lit("star").alias("dataset_id"), F.col("c_name").alias("table_name"), F.lit("email").alias("column_name"))
    return pii.flag_tables(_customer_tables(spark, sf_dir), found).drop("labels")


# --- query log ----------------------------------------------------------------------------------
# Each event is a job: its user ran a query over a table numbered by the event's property.

END_OF_LOG = dt.datetime(2024, 1, 31)


def query_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.get_json_object("props", "$.k")
    kind = F.col("event_type")
    ref = lambda dataset, t: F.struct(
        F.lit("p").alias("project_id"), F.lit(dataset).alias("dataset_id"), t.alias("table_id"))
    staged_table = F.concat(F.lit("s"), F.col("user_id"))
    source = ref("raw", F.concat(F.lit("t"), k))
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("job-"), F.col("event_id")).alias("job_id"),
        F.when(kind != "error", F.concat(F.lit("user"), F.col("user_id"), F.lit("@example.com"))).alias("user_email"),
        F.when(kind == "signup", "LOAD").otherwise("QUERY").alias("job_type"),
        F.when(kind == "error", "FAILED").otherwise("DONE").alias("state"),
        F.col("ts").alias("creation_time"),
        F.timestamp_add("SECOND", F.floor(F.col("value") * 10), F.col("ts")).alias("end_time"),
        F.floor(F.col("value") * 1000000).alias("bytes_processed"),
        (F.ceil(F.col("value")) * 10485760).alias("bytes_billed"),
        (kind == "view").alias("cache_hit"),
        F.when(kind != "click", "SELECT").alias("statement_type"),
        F.repeat(F.concat(F.lit("SELECT * FROM t"), k, F.lit(" /* "), F.col("event_id"), F.lit(" */ ")),
                 (F.col("user_id") % 40 + 1).cast("int")).alias("query"),
        F.when(kind == "click", F.array().cast("array<struct<project_id:string,dataset_id:string,table_id:string>>"))
         .when(kind == "view", F.array(source, ref("staging", staged_table)))
         .otherwise(F.array(source)).alias("referenced_tables"),
        F.when(kind == "purchase", ref("staging", staged_table))
         .when(kind == "view", ref("analytics", kind)).alias("destination_table"))


_LOG_SQL = """SELECT 'job-' || event_id AS job_id, CASE WHEN event_type <> 'error' THEN 'user' || user_id || '@example.com' END AS user_email,
 CASE WHEN event_type = 'signup' THEN 'LOAD' ELSE 'QUERY' END AS job_type,
 CASE WHEN event_type = 'error' THEN 'FAILED' ELSE 'DONE' END AS state, ts AS creation_time,
 ts + to_seconds(CAST(floor(value * 10) AS BIGINT)) AS end_time, CAST(floor(value * 1000000) AS BIGINT) AS bytes_processed,
 CAST(ceil(value) AS BIGINT) * 10485760 AS bytes_billed, event_type = 'view' AS cache_hit,
 CASE WHEN event_type <> 'click' THEN 'SELECT' END AS statement_type,
 repeat('SELECT * FROM t' || json_extract_string(props, '$.k') || ' /* ' || event_id || ' */ ', user_id % 40 + 1) AS query,
 't' || json_extract_string(props, '$.k') AS src, 's' || user_id AS stg, event_type FROM events"""

_HISTORY_SQL = f"""SELECT * EXCLUDE (query), left(query, 500) AS query_preview FROM ({_LOG_SQL})
 WHERE creation_time > TIMESTAMP '2024-01-31' - INTERVAL 7 DAY AND job_type = 'QUERY'"""
_TOP_SQL = f"{_HISTORY_SQL} ORDER BY creation_time DESC, job_id LIMIT 50"
_SHOWN = ["job_id", "user_email", "job_type", "state", "creation_time", "end_time", "bytes_processed",
          "bytes_billed", "cache_hit", "statement_type", "query_preview"]
_SHOWN_SQL = ", ".join(_SHOWN)

for _id in ("D18_job_history", "O3_top_k_latest"):
    query(_id, f"SELECT {_SHOWN_SQL} FROM ({_TOP_SQL})")(
        lambda spark, sf_dir: usage.job_history(query_log(spark, sf_dir), END_OF_LOG).select(*_SHOWN))


def _whole_history(spark, sf_dir) -> DataFrame:
    return usage.job_history(query_log(spark, sf_dir), END_OF_LOG, rows=None)


for _id in ("P6_time_window", "P7_conjunction"):
    query(_id, f"SELECT {_SHOWN_SQL} FROM ({_HISTORY_SQL})")(
        lambda spark, sf_dir: _whole_history(spark, sf_dir).select(*_SHOWN))

for _id in ("D19_job_summary", "A15_ratio"):
    query(_id, f"""
SELECT count(*) AS total, count(DISTINCT user_email) AS unique_users, count(*) FILTER (WHERE state = 'DONE') AS successful,
 count(*) FILTER (WHERE cache_hit) AS cached, round(count(*) FILTER (WHERE cache_hit) / count(*) * 100, 0) AS cache_rate,
 CAST(sum(bytes_processed) AS BIGINT) AS total_bytes, CAST(sum(bytes_billed) AS BIGINT) AS total_billed FROM ({_HISTORY_SQL})""")(
        lambda spark, sf_dir: usage.job_summary(_whole_history(spark, sf_dir)))


def bytes_sql(c: str) -> str:
    """Base-1024 size text."""
    def one(power: int, unit: str) -> str:
        q = f"CAST(round({c} / {float(1024 ** power)}, 2) AS DECIMAL(30,2))"
        return f"regexp_replace(CAST({q} AS VARCHAR), '[.]?0+$', '') || ' {unit}'"
    cases = " ".join(f"WHEN {c} >= {1024 ** p} THEN {one(p, u)}" for p, u in ((4, "TB"), (3, "GB"), (2, "MB"), (1, "KB")))
    return f"CASE WHEN coalesce({c}, 0) = 0 THEN '0 B' {cases} ELSE {one(0, 'B')} END"


def duration_sql(a: str, b: str) -> str:
    ms = f"floor((epoch_us({b}) - epoch_us({a})) / 1000)"
    short = lambda d: f"CAST(CAST(round(({ms}) / {d}.0, 1) AS DECIMAL(20,1)) AS VARCHAR)"
    return (f"CASE WHEN {a} IS NULL OR {b} IS NULL THEN '-' WHEN {ms} < 1000 THEN CAST(CAST({ms} AS BIGINT) AS VARCHAR) || 'ms' "
            f"WHEN {ms} < 60000 THEN {short(1000)} || 's' ELSE {short(60000)} || 'm' END")


query("D20_job_list", f"""
SELECT job_id, strftime(creation_time, '%b %-d, %Y, %-I:%M %p') AS started,
 coalesce(split_part(user_email, '@', 1), '-') AS user, coalesce(statement_type, job_type) AS statement, state,
 {bytes_sql('bytes_processed')} AS processed, {bytes_sql('bytes_billed')} AS billed,
 {duration_sql('creation_time', 'end_time')} AS duration, CASE WHEN cache_hit THEN 'Y' ELSE '-' END AS cached,
 CAST(CASE event_type WHEN 'click' THEN 0 WHEN 'view' THEN 2 ELSE 1 END AS BIGINT) AS tables,
 CASE WHEN length(trim(query_preview)) > 80 THEN left(trim(query_preview), 80) || '...' ELSE trim(query_preview) END AS preview
 FROM ({_HISTORY_SQL})""")(lambda spark, sf_dir: usage.job_list(_whole_history(spark, sf_dir)))

_EDGES_SQL = f"""SELECT upstream, downstream, count(*) AS jobs, max(end_time) AS last_used FROM (
 SELECT 'raw.' || src AS upstream, CASE event_type WHEN 'purchase' THEN 'staging.' || stg ELSE 'analytics.view' END AS downstream, end_time
 FROM ({_LOG_SQL}) WHERE event_type IN ('purchase', 'view')
 UNION ALL SELECT 'staging.' || stg, 'analytics.view', end_time FROM ({_LOG_SQL}) WHERE event_type = 'view') GROUP BY 1, 2"""

query("G5_usage_lineage", _EDGES_SQL)(
    lambda spark, sf_dir: usage.usage_edges(query_log(spark, sf_dir)))


# --- lineage ------------------------------------------------------------------------------------

def _part_edges(spark, sf_dir) -> DataFrame:
    """part -> supplier (one edge per line), supplier -> nation, nation -> region."""
    li, s, n = (table(spark, sf_dir, t) for t in ("lineitem", "supplier", "nation"))
    edge = lambda df, base, a, b, up, down, how: df.select(
        (F.lit(base) + F.col(a).cast("long")).alias("ordinal"),
        F.concat(F.lit(up), F.col(a)).alias("upstream"),
        F.concat(F.lit(down), F.col(b)).alias("downstream"), F.lit(how).alias("transform"))
    lines = li.select((F.col("l_orderkey") * 1000 + F.col("l_linenumber") * 100 + F.col("l_suppkey") % 100).alias("ordinal"),
                      F.concat(F.lit("raw.part.p"), F.col("l_partkey")).alias("upstream"),
                      F.concat(F.lit("staging.supplier.s"), F.col("l_suppkey")).alias("downstream"),
                      F.lit("supplied").alias("transform"))
    return (lines.unionByName(edge(s, 10 ** 12, "s_suppkey", "s_nationkey", "staging.supplier.s", "analytics.nation.n", "located"))
            .unionByName(edge(n, 2 * 10 ** 12, "n_nationkey", "n_regionkey", "analytics.nation.n", "reporting.region.r", "grouped")))


_EDGE_LIST_SQL = """
 SELECT l_orderkey * 1000 + l_linenumber * 100 + l_suppkey % 100 AS ordinal, 'raw.part.p' || l_partkey AS upstream,
 'staging.supplier.s' || l_suppkey AS downstream, 'supplied' AS transform FROM lineitem
 UNION ALL SELECT 1000000000000 + s_suppkey, 'staging.supplier.s' || s_suppkey, 'analytics.nation.n' || s_nationkey, 'located' FROM supplier
 UNION ALL SELECT 2000000000000 + n_nationkey, 'analytics.nation.n' || n_nationkey, 'reporting.region.r' || n_regionkey, 'grouped' FROM nation"""

_TRACE_SQL = f"""WITH RECURSIVE edges AS MATERIALIZED ({_EDGE_LIST_SQL}),
 nodes AS (SELECT upstream AS start FROM edges UNION SELECT downstream FROM edges),
 first_up AS MATERIALIZED (SELECT downstream AS here, arg_min(upstream, (ordinal, upstream, transform)) AS upstream,
  arg_min(transform, (ordinal, upstream, transform)) AS transform FROM edges GROUP BY 1),
 first_down AS MATERIALIZED (SELECT upstream AS here, arg_min(downstream, (ordinal, downstream, transform)) AS downstream,
  arg_min(transform, (ordinal, downstream, transform)) AS transform FROM edges GROUP BY 1),
 up AS (SELECT start, CAST(-1 AS BIGINT) AS position, upstream, here AS downstream, transform FROM nodes JOIN first_up ON here = start
  UNION ALL SELECT start, position - 1, f.upstream, f.here, f.transform FROM up JOIN first_up f ON f.here = up.upstream WHERE position > -10),
 down AS (SELECT start, CAST(1 AS BIGINT) AS position, here AS upstream, downstream, transform FROM nodes JOIN first_down ON here = start
  UNION ALL SELECT start, position + 1, f.here, f.downstream, f.transform FROM down JOIN first_down f ON f.here = down.downstream WHERE position < 10)
 SELECT start, 'up' AS direction, position, upstream, downstream, transform FROM up
 UNION ALL SELECT start, 'down', position, upstream, downstream, transform FROM down"""

for _id in ("G3_trace", "J6_bounded_walk"):
    @query(_id, _TRACE_SQL)
    def trace(spark, sf_dir):
        edges = _part_edges(spark, sf_dir)
        return lineage.trace(edges, lineage.node_names(edges).toDF("start"))


@query("G3_trace_closure", f"""WITH RECURSIVE edges AS MATERIALIZED ({_EDGE_LIST_SQL}),
 nodes AS (SELECT 'staging.supplier.s' || s_suppkey AS start FROM supplier UNION SELECT 'analytics.nation.n' || n_nationkey FROM nation),
 up AS (SELECT start, start AS node, CAST(0 AS BIGINT) AS hop FROM nodes
  UNION SELECT up.start, e.upstream, hop + 1 FROM up JOIN edges e ON e.downstream = up.node),
 down AS (SELECT start, start AS node, CAST(0 AS BIGINT) AS hop FROM nodes
  UNION SELECT down.start, e.downstream, hop + 1 FROM down JOIN edges e ON e.upstream = down.node)
 SELECT start, 'up' AS direction, -(hop + 1) AS position, upstream, downstream, transform FROM up JOIN edges ON downstream = node
 UNION ALL SELECT start, 'down', hop + 1, upstream, downstream, transform FROM down JOIN edges ON upstream = node""")
def trace_closure(spark, sf_dir):
    """Every edge around every supplier and nation; the graph has no cycle and each node one distance."""
    edges = _part_edges(spark, sf_dir)
    starts = lineage.node_names(edges).toDF("start").where(
        F.col("start").startswith("staging.supplier.") | F.col("start").startswith("analytics.nation."))
    return lineage.trace(edges, starts, first_only=False)


@query("G3_trace_deep", """
WITH RECURSIVE o AS (SELECT o_orderkey AS k, lead(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS nxt FROM orders),
 walk AS (SELECT k AS start, k AS node, CAST(0 AS BIGINT) AS hop FROM (SELECT min(o_orderkey) AS k FROM orders GROUP BY o_custkey)
  UNION ALL SELECT start, nxt, hop + 1 FROM walk JOIN o ON k = node WHERE nxt IS NOT NULL)
 SELECT 'o.' || start AS start, 'down' AS direction, hop + 1 AS position, 'o.' || node AS upstream, 'o.' || nxt AS downstream,
  'next' AS transform FROM walk JOIN o ON k = node WHERE nxt IS NOT NULL""")
def trace_deep(spark, sf_dir):
    """Each customer's orders as a chain, followed from the first order to the last, however many there are."""
    orders = table(spark, sf_dir, "orders")
    after = F.lead("o_orderkey").over(W.partitionBy("o_custkey").orderBy("o_orderkey"))
    name = lambda c: F.concat(F.lit("o."), c)
    edges = orders.withColumn("after", after).where("after IS NOT NULL").select(
        F.col("o_orderkey").alias("ordinal"), name(F.col("o_orderkey")).alias("upstream"), name(F.col("after")).alias("downstream"),
        F.lit("next").alias("transform"))
    starts = orders.groupBy("o_custkey").agg(F.min("o_orderkey").alias("k")).select(name(F.col("k")).alias("start"))
    return lineage.trace(edges, starts).where("direction = 'down'")

for _id in ("O5_lineage_nodes", "U2_union_distinct"):
    query(_id, f"SELECT upstream AS node FROM ({_EDGE_LIST_SQL}) UNION SELECT downstream FROM ({_EDGE_LIST_SQL})")(
        lambda spark, sf_dir: lineage.node_names(_part_edges(spark, sf_dir)).orderBy("node"))

query("F28_short_names", f"""
SELECT upstream, CASE WHEN len(string_split(upstream, '.')) > 2 THEN
 string_split(upstream, '.')[-2] || '.' || string_split(upstream, '.')[-1] ELSE upstream END AS short_name
 FROM (SELECT DISTINCT upstream FROM ({_EDGE_LIST_SQL}))""")(
    lambda spark, sf_dir: _part_edges(spark, sf_dir).select("upstream").distinct().withColumn(
        "short_name", last_two_parts(F.col("upstream"))))

query("G4_neighbourhood", f"""
SELECT DISTINCT unnest([upstream, downstream]) AS node FROM ({_EDGES_SQL})
 WHERE upstream = 'staging.s5' OR downstream = 'staging.s5'""")(
    lambda spark, sf_dir: lineage.neighbourhood(usage.usage_edges(query_log(spark, sf_dir)), "staging.s5"))


@query("G6_layer_nodes", f"""
SELECT layer, node, row_number() OVER (PARTITION BY layer ORDER BY ordinal, node) - 1 AS position FROM (
 SELECT split_part(node, '.', 1) AS layer, node, min(ordinal) AS ordinal FROM (
 SELECT upstream AS node, ordinal * 2 AS ordinal FROM ({_EDGE_LIST_SQL})
 UNION ALL SELECT downstream, ordinal * 2 + 1 FROM ({_EDGE_LIST_SQL})) GROUP BY node)""")
def layer_nodes(spark, sf_dir):
    edges = _part_edges(spark, sf_dir)
    nodes = edges.select(F.col("upstream").alias("node"), (F.col("ordinal") * 2).alias("ordinal")).unionByName(
        edges.select(F.col("downstream").alias("node"), (F.col("ordinal") * 2 + 1).alias("ordinal")))
    first = nodes.groupBy("node").agg(F.min("ordinal").alias("ordinal"))
    layered = inventory.layer_nodes(first.select(
        "ordinal", F.split_part("node", F.lit("."), F.lit(1)).alias("dataset_id"), F.col("node").alias("table_name")))
    return skew.position_in_group(
        first.join(layered, F.col("node") == F.col("table_name")), "layer", "ordinal", ["node"]).select("layer", "node", "position")


def _pipeline_inventory(spark, sf_dir) -> DataFrame:
    counted = None
    layers = {f"raw_ecommerce.{n}": retail.raw(spark, sf_dir, n) for n in retail.RAW_BUILDERS}
    layers |= {f"staging_ecommerce.stg_{n}": staged(spark, sf_dir, n) for n in retail.RAW_BUILDERS}
    layers |= {f"analytics_ecommerce.{n}": mart(spark, sf_dir, n) for n in
               ("customer_360", "product_performance", "revenue_daily", "order_fulfillment")}
    for name, df in layers.items():
        dataset, _, t = name.partition(".")
        one = df.agg(F.count("*").alias("num_rows")).select(
            F.lit(dataset).alias("dataset_id"), F.lit(t).alias("table_name"), "num_rows")
        counted = one if counted is None else counted.unionByName(one)
    return counted


_VOLUME_LAYERS = ["customers", "products", "orders", "order_items", "payments", "shipping_events"]


def _volume_sql(edge_rows: str, prefix: bool) -> str:
    from ..plans.staging import STAGING
    from .layers_sql import MARTS
    counts = "\n UNION ALL ".join(
        [f"SELECT 'raw_ecommerce.{n}' AS node, count(*) AS num_rows FROM raw_{n}" for n in STAGING]
        + [f"SELECT 'staging_ecommerce.stg_{n}', count(*) FROM stg_{n}" for n in STAGING]
        + [f"SELECT 'analytics_ecommerce.{n}', count(*) FROM {n}" for n in MARTS])
    key = "regexp_extract({}, '^[^.]+[.][^.]+')" if prefix else "{}"
    return with_layers(f"""SELECT e.*, u.num_rows AS upstream_rows, d.num_rows AS downstream_rows FROM ({edge_rows}) e
 LEFT JOIN ({counts}) u ON u.node = {key.format('e.upstream')} LEFT JOIN ({counts}) d ON d.node = {key.format('e.downstream')}""",
                       *_VOLUME_LAYERS, *MARTS)


def _edge_values(edges: list[tuple[str, str, str]]) -> str:
    values = ", ".join(f"({i}, '{u}', '{d}', '{t}')" for i, (u, d, t) in enumerate(edges))
    return f"SELECT CAST(o AS BIGINT) AS ordinal, upstream, downstream, transform FROM (VALUES {values}) AS v(o, upstream, downstream, transform)"


def _register_declared_lineage() -> None:
    from ..operators.pipeline_lineage import COLUMN_EDGES, TABLE_EDGES

    @query("G1_table_lineage", _volume_sql(_edge_values(TABLE_EDGES), False))
    def table_lineage(spark, sf_dir):
        return lineage.edge_volumes(table_edges(spark), _pipeline_inventory(spark, sf_dir))

    @query("G2_column_lineage", _volume_sql(_edge_values(COLUMN_EDGES), True))
    def column_lineage(spark, sf_dir):
        edges = column_edges(spark)
        owner = lambda c: F.regexp_extract(c, r"^[^.]+\.[^.]+", 0)
        sizes = _pipeline_inventory(spark, sf_dir)
        tables = edges.select("ordinal", owner("upstream").alias("upstream"), owner("downstream").alias("downstream"))
        volumes = lineage.edge_volumes(tables, sizes).select("ordinal", "upstream_rows", "downstream_rows")
        return edges.join(volumes, "ordinal")


_register_declared_lineage()
