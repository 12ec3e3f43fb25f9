"""Findings about tables that need more than one plain aggregate: values, failing columns, trees, sketches, layouts."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import constraints, inventory, pii, pii_values, profile, sketches
from ..operators.skew import stored
from ..operators.specs import TableSpec
from ..plans import upkeep
from ..session import fresh_path
from ..sources import sinks
from ..sources.retail import table
from .layers_sql import with_layers
from .metadata import _S, STAR, STAR_COLUMNS, profile_sql
from .pipeline import mart, staged
from .registry import query

C = F.col


def _star(spark: SparkSession, sf_dir: str, *names: str) -> list[TableSpec]:
    return [TableSpec("star", n, table(spark, sf_dir, n)) for n in names]


# --- personal data by value -----------------------------------------------------------------------

def _real_sql(name: str) -> str:
    """DuckDB's form of the rule that tells real values from lookalikes."""
    d = "regexp_replace(x, '[^0-9]', '', 'g')"
    luhn = (f"list_sum(list_transform(range(1, length({d}) + 1), lambda i: CASE WHEN (length({d}) - i) % 2 = 1 "
            f"THEN CAST(substr({d}, i, 1) AS INT) * 2 - CASE WHEN CAST(substr({d}, i, 1) AS INT) > 4 THEN 9 ELSE 0 END "
            f"ELSE CAST(substr({d}, i, 1) AS INT) END)) % 10 = 0")
    return {
        "Email Address": "true",
        "Phone Number": f"length({d}) BETWEEN 8 AND 15",
        "Social Security Number": f"substr({d}, 1, 3) NOT IN ('000', '666') AND substr({d}, 1, 3) < '900' AND substr({d}, 4, 2) <> '00' AND substr({d}, 6, 4) <> '0000'",
        "Payment Card Number": f"length({d}) BETWEEN 13 AND 19 AND {luhn}",
        "IP Address": "list_bool_and(list_transform(string_split(x, '.'), lambda p: length(p) <= 3 AND lpad(p, 3, '0') <= '255'))",
    }[name]


def _scan_sql(dataset: str, name: str, source: str, columns: list[str]) -> str:
    parts = []
    for c in columns:
        for r in pii_values.VALUE_RULES:
            parts.append(f"""SELECT '{dataset}' AS dataset_id, '{name}' AS table_name, '{c}' AS column_name, '{r.name}' AS pii_classification,
 count(v) AS filled_rows, count(*) FILTER (len(real) > 0) AS rows_with_hits, CAST(sum(len(real)) AS BIGINT) AS hits,
 CAST(sum(len(seen)) - sum(len(real)) AS BIGINT) AS rejected
 FROM (SELECT v, seen, list_filter(seen, lambda x: {_real_sql(r.name)}) AS real
  FROM (SELECT "{c}" AS v, coalesce(regexp_extract_all("{c}", '{r.pattern}', {r.group}), []) AS seen FROM {source}))""")
    rows = "\nUNION ALL ".join(parts)
    return f"""SELECT *, round(rows_with_hits * 100.0 / filled_rows, 4) AS hit_rate_pct,
 CASE WHEN round(rows_with_hits * 100.0 / filled_rows, 4) >= 50 THEN 'high' WHEN round(rows_with_hits * 100.0 / filled_rows, 4) >= 5 THEN 'medium' ELSE 'low' END AS confidence
 FROM ({rows}) WHERE hits > 0"""


def _text_columns(name: str) -> list[str]:
    return [c for c, kind in STAR_COLUMNS[name].items() if kind == _S]


_SCANNED = [n for n in STAR if _text_columns(n)]
_VALUE_SQL = "\nUNION ALL ".join(f"({_scan_sql('star', n, n, _text_columns(n))})" for n in _SCANNED)

query("D14_value_scan", _VALUE_SQL)(lambda spark, sf_dir: pii_values.scan_tables(_star(spark, sf_dir, *_SCANNED)))

# Customers carry an e-mail by name and by value; phone and address columns are named so whatever they hold.
_CUSTOMER_TEXT = ["customer_id", "first_name", "last_name", "email", "phone", "gender", "address_line1", "city", "state", "country",
                  "postal_code", "source_system"]
_NAMED_SQL = "SELECT * FROM (VALUES " + ", ".join(
    f"('staging', 'customers', '{c}', '{cls}', '{'high' if c == kw else 'medium'}')" for c in [*_CUSTOMER_TEXT, "date_of_birth"]
    for kw, cls in [next(((k, v) for k, v in pii.PII_KEYWORDS if k in c), (None, None))] if kw) + \
    ") AS v(dataset_id, table_name, column_name, pii_classification, name_confidence)"


@query("D14_name_and_value", with_layers(f"""
SELECT coalesce(n.dataset_id, v.dataset_id) AS dataset_id, coalesce(n.table_name, v.table_name) AS table_name,
 coalesce(n.column_name, v.column_name) AS column_name, coalesce(n.pii_classification, v.pii_classification) AS pii_classification,
 name_confidence, hit_rate_pct, confidence AS value_confidence,
 concat_ws('+', CASE WHEN name_confidence IS NOT NULL THEN 'name' END, CASE WHEN confidence IS NOT NULL THEN 'value' END) AS source
 FROM ({_NAMED_SQL}) n FULL JOIN ({_scan_sql('staging', 'customers', 'stg_customers', _CUSTOMER_TEXT)}) v ON n.column_name = v.column_name AND n.pii_classification = v.pii_classification""", "customers"))
def name_and_value(spark, sf_dir):
    spec = TableSpec("staging", "customers", staged(spark, sf_dir, "customers"))
    named = pii.classify_columns(inventory.column_inventory(spark, [spec]))
    return pii_values.by_name_and_value(named, pii_values.scan_values(spec))


# --- profiles -------------------------------------------------------------------------------------

_FINE = {"o_orderkey": "number", "o_orderstatus": "text", "o_totalprice": "number", "o_orderdate": "time"}
_PROFILE_COLUMNS = ["dataset_id", "table_name", "ordinal_position", "column_name", "total_rows", "null_count", "distinct_count",
                    "min_number", "max_number", "max_length", "status"]


@query("D2_failing_column", "SELECT {} FROM ({}) UNION ALL SELECT {}".format(
    ", ".join(_PROFILE_COLUMNS), profile_sql("star", "v_orders", _FINE, "orders"),
    "'star', 'v_orders', 5, 'tiny_price', NULL, NULL, NULL, NULL, NULL, NULL, 'error: CAST_OVERFLOW' "
    "UNION ALL SELECT 'star', 'v_orders', 6, 'status_number', NULL, NULL, NULL, NULL, NULL, NULL, 'error: CAST_INVALID_INPUT'"))
def failing_column(spark, sf_dir):
    """Two computed columns fail on the data; the other four are profiled all the same."""
    orders = table(spark, sf_dir, "orders").select(
        *_FINE, C("o_totalprice").cast("tinyint").alias("tiny_price"), C("o_orderstatus").cast("int").alias("status_number"))
    return profile.profile_isolated(TableSpec("star", "v_orders", orders)).select(_PROFILE_COLUMNS)


_TIMES = {"orders": ["o_orderdate"], "lineitem": ["l_shipdate"], "events": ["ts"]}

query("D1_time_extremes", "\nUNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, left(CAST(min({c}) AS VARCHAR), 19) AS min_text, left(CAST(max({c}) AS VARCHAR), 19) AS max_text, "
    f"'timestamp_ntz' AS data_type FROM {t}" for t, columns in _TIMES.items() for c in columns))(
    lambda spark, sf_dir: profile.profile_tables(_star(spark, sf_dir, *_TIMES)).where("min_text IS NOT NULL").select(
        "table_name", "column_name", F.rpad("min_text", 19, " ").alias("min_text"), F.rpad("max_text", 19, " ").alias("max_text"), "data_type"))


def _sketch_sql() -> str:
    parts = []
    for i, (c, kind) in enumerate(STAR_COLUMNS["orders"].items()):
        n = f"CAST({c} AS DOUBLE)" if kind == "number" else "CAST(NULL AS DOUBLE)"
        parts.append(f"SELECT CAST({i + 1} AS BIGINT) AS ordinal_position, '{c}' AS column_name, count(*) AS total_rows, count(*) - count({c}) AS null_count, "
                     f"min({n}) AS min_number, max({n}) AS max_number, round(avg({n}), 4) AS mean, true AS as_rebuilt, true AS within_bound FROM orders")
    return "\nUNION ALL ".join(parts)


@query("D1_refreshed_sketches", _sketch_sql())
def refreshed_sketches(spark, sf_dir):
    """Sketches built without the rows of some months, refreshed by those months, beside sketches of the whole and exact counts."""
    orders = table(spark, sf_dir, "orders").withColumn("month", F.date_format("o_orderdate", "yyyy-MM"))
    late = C("month").isin("1995-03", "1997-11")
    first, whole = fresh_path(spark, "sketches"), fresh_path(spark, "sketches")
    sketches.store_sketches(orders.where(~late | (C("o_orderkey") % 2 == 0)), "month", first)
    sketches.refresh_sketches(orders, "month", ["1995-03", "1997-11"], first)
    sketches.store_sketches(orders, "month", whole)
    got = sketches.profile_from_sketches(spark, first)
    again = sketches.profile_from_sketches(spark, whole).select("column_name", C("distinct_estimate").alias("again"))
    exact = profile.profile_table(TableSpec("star", "orders", orders.drop("month"))).select("column_name", C("distinct_count").alias("exact"))
    error = F.abs(C("distinct_estimate") - C("exact")) / C("exact")
    return got.join(again, "column_name").join(exact, "column_name").select(
        "ordinal_position", "column_name", "total_rows", "null_count", "min_number", "max_number", "mean",
        (C("distinct_estimate") == C("again")).alias("as_rebuilt"), (error <= 0.05).alias("within_bound"))


# --- trees ----------------------------------------------------------------------------------------

query("D8_json_tree", """
SELECT 'props' AS field_path, 'OBJECT' AS data_type, count(props) AS n_values, CAST(0 AS BIGINT) AS n_null FROM events
UNION ALL SELECT 'props.' || k, 'BIGINT', count(json_extract_string(props, '$.' || k)),
 count(*) - count(json_extract_string(props, '$.' || k)) FROM (SELECT props, unnest(json_keys(props)) AS k FROM events) GROUP BY k""")(
    lambda spark, sf_dir: inventory.json_tree(table(spark, sf_dir, "events"), "props"))


@query("D8_json_tree_deep", """
WITH n AS (SELECT n_regionkey, count(*) AS k, count(*) FILTER (n_nationkey % 3 = 0) AS third, sum(c) AS customers, sum(low) AS low
 FROM (SELECT n.*, count(c_custkey) AS c, count(*) FILTER (c_acctbal < 0) AS low FROM nation n LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY ALL) n GROUP BY 1),
r AS (SELECT count(*) AS regions, CAST(sum(k) AS BIGINT) AS nations, CAST(sum(third) AS BIGINT) AS third, CAST(sum(customers) AS BIGINT) AS customers,
 CAST(sum(low) AS BIGINT) AS low FROM n)
SELECT v.* FROM r, LATERAL (VALUES
 ('doc', 'OBJECT', regions, 0), ('doc.region', 'STRING', regions, 0), ('doc.nations', 'ARRAY', regions, 0), ('doc.nations[]', 'OBJECT', nations, 0),
 ('doc.nations[].name', 'STRING', nations, 0), ('doc.nations[].code', 'BIGINT', nations - third, third),
 ('doc.nations[].customers', 'ARRAY', nations, 0), ('doc.nations[].customers[]', 'OBJECT', customers, 0),
 ('doc.nations[].customers[].id', 'BIGINT', customers, 0), ('doc.nations[].customers[].debt', 'BOOLEAN', low, 0)) AS v(field_path, data_type, n_values, n_null)""")
def json_tree_deep(spark, sf_dir):
    """One document per region: nations, their customers, a code that is null for some and a flag that most lack."""
    c, n, r = (table(spark, sf_dir, t) for t in ("customer", "nation", "region"))
    person = F.concat(F.lit('{"id":'), C("c_custkey").cast("string"), F.when(C("c_acctbal") < 0, ',"debt":true}').otherwise("}"))
    people = c.groupBy("c_nationkey").agg(F.concat(F.lit("["), F.array_join(F.collect_list(person), ","), F.lit("]")).alias("people"))
    code = F.when(C("n_nationkey") % 3 == 0, "null").otherwise(C("n_nationkey").cast("string"))
    nation = F.concat(F.lit('{"name":"'), C("n_name"), F.lit('","code":'), code, F.lit(',"customers":'), F.coalesce("people", F.lit("[]")), F.lit("}"))
    nations = n.join(people, C("n_nationkey") == C("c_nationkey"), "left").groupBy("n_regionkey").agg(
        F.array_join(F.collect_list(nation), ",").alias("nations"))
    docs = r.join(nations, C("r_regionkey") == C("n_regionkey")).select(
        F.concat(F.lit('{"region":"'), C("r_name"), F.lit('","nations":['), C("nations"), F.lit("]}")).alias("doc"))
    return inventory.json_tree(docs, "doc")


# --- layouts, partitions, columns -----------------------------------------------------------------

@query("S6_bucketed_join", """
SELECT o_orderkey, o_totalprice, count(*) AS lines, CAST(sum(l_quantity) AS DOUBLE) AS quantity FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1, 2""")
def bucketed_join(spark, sf_dir):
    """Orders and lines stored in buckets of the order key meet, and are grouped, without a shuffle."""
    names = [f"bucketed_{t}_{uuid.uuid4().hex}" for t in ("orders", "lines")]
    for name, t, key in zip(names, ("orders", "lineitem"), ("o_orderkey", "l_orderkey")):
        sinks.write_bucketed(table(spark, sf_dir, t), name, fresh_path(spark, name), key, 8)
    orders, lines = (spark.table(n) for n in names)
    return orders.hint("merge").join(lines, orders.o_orderkey == lines.l_orderkey).groupBy("o_orderkey", "o_totalprice").agg(
        F.count("*").alias("lines"), F.sum("l_quantity").cast("double").alias("quantity"))


@query("D5_written_layout", with_layers("""
SELECT 'orders_by_month' AS table_name, count(*) AS num_rows, 'order_month' AS partition_column, '' AS clustering_fields FROM stg_orders
UNION ALL SELECT 'orders_staged', count(*), 'order_month', 'customer_id' FROM stg_orders
UNION ALL SELECT 'fulfilment', count(*), NULL, 'order_status,payment_method' FROM order_fulfillment
UNION ALL SELECT 'customers', count(*), NULL, '' FROM stg_customers""", "orders", "customers", "order_fulfillment"))
def written_layout(spark, sf_dir):
    """Four tables by four writers; the inventory shows the layout each writer recorded."""
    orders = staged(spark, sf_dir, "orders")
    paths = {n: fresh_path(spark, n) for n in ("orders_by_month", "orders_staged", "fulfilment", "customers")}
    sinks.write_partitioned(upkeep.with_month(orders), paths["orders_by_month"], "order_month")
    upkeep.store_staged_orders(orders, paths["orders_staged"], "order_month")
    # Range bounds are sampled by running the plan once more; the mart is stored, so its joins run once.
    sinks.write_clustered(stored(mart(spark, sf_dir, "order_fulfillment"), "fulfilment-plain"), paths["fulfilment"], "order_status", "payment_method")
    sinks.overwrite(staged(spark, sf_dir, "customers"), paths["customers"])
    specs = [inventory.stored_spec(spark, "lake", n, p) for n, p in paths.items()]
    return inventory.table_inventory(specs).select(
        "table_name", "num_rows", "partition_column", F.array_join("clustering_fields", ",").alias("clustering_fields"))


_PARTITION_OF = {"orders": ("o_orderdate", "%Y%m", "yyyyMM"), "lineitem": ("l_shipdate", "%Y%m", "yyyyMM"), "events": ("ts", "%Y%m%d", "yyyyMMdd")}
_ALL_PARTITIONS_SQL = "\nUNION ALL ".join(
    f"SELECT 'star' AS dataset_id, '{n}' AS table_name, " +
    (f"strftime({_PARTITION_OF[n][0]}, '{_PARTITION_OF[n][1]}')" if n in _PARTITION_OF else f"'{inventory.UNPARTITIONED}'") +
    f" AS partition_id, count(*) AS total_rows FROM {n} GROUP BY ALL" for n in STAR)


def _all_partitions(spark, sf_dir) -> DataFrame:
    ids = {n: F.date_format(c, fmt) for n, (c, _, fmt) in _PARTITION_OF.items()}
    return inventory.all_partition_stats(_star(spark, sf_dir, *STAR), ids)


query("D9_all_partitions", _ALL_PARTITIONS_SQL)(
    lambda spark, sf_dir: _all_partitions(spark, sf_dir).select("dataset_id", "table_name", "partition_id", "total_rows"))

query("D10_all_storage", f"SELECT dataset_id, table_name, CAST(sum(total_rows) AS BIGINT) AS total_rows, count(*) AS total_partitions FROM ({_ALL_PARTITIONS_SQL}) GROUP BY ALL")(
    lambda spark, sf_dir: inventory.all_storage_stats(_all_partitions(spark, sf_dir)).select("dataset_id", "table_name", "total_rows", "total_partitions"))


_ATTRIBUTES = {"o_totalprice": {"CURRENT_DEFAULT": "0.0", "rounding_mode": "ROUND_HALF_EVEN"}, "o_year": {"generation_expression": "year(o_orderdate)"},
               "_loaded": {"system_defined": True}}


@query("D7_column_attributes", """
SELECT c.*, n AS present_rows FROM (SELECT count(*) AS n FROM orders), (VALUES
 ('o_orderkey', CAST(1 AS BIGINT), 'NO', NULL, 'NO', 'NO', 'NEVER', NULL, NULL, NULL, NULL),
 ('o_totalprice', 2, 'NO', NULL, 'NO', 'NO', 'NEVER', NULL, '0.0', NULL, 'ROUND_HALF_EVEN'),
 ('o_orderstatus', 3, 'NO', CAST(1 AS BIGINT), 'NO', 'NO', 'NEVER', NULL, NULL, 'UTF8_LCASE', NULL),
 ('o_year', 4, 'YES', NULL, 'NO', 'NO', 'ALWAYS', 'year(o_orderdate)', NULL, NULL, NULL),
 ('_loaded', 5, 'NO', NULL, 'YES', 'YES', 'NEVER', NULL, NULL, NULL, NULL))
 AS c(column_name, ordinal_position, is_partitioning_column, clustering_ordinal_position, is_hidden, is_system_defined, is_generated,
  generation_expression, column_default, collation_name, rounding_mode)""")
def column_attributes(spark, sf_dir):
    """Attributes that a field's metadata and type carry, beside the filled rows of each column."""
    df = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_totalprice", F.collate("o_orderstatus", "UTF8_LCASE").alias("o_orderstatus"), F.year("o_orderdate").alias("o_year"),
        F.lit(True).alias("_loaded"))
    for name, metadata in _ATTRIBUTES.items():
        df = df.withMetadata(name, metadata)
    spec = TableSpec("star", "orders_typed", df, partition_column="o_year", cluster_columns=("o_orderstatus",))
    filled = inventory.field_paths(spec).select("column_name", "present_rows")
    return inventory.column_inventory(spark, [spec]).drop("dataset_id", "table_name", "is_nullable", "data_type").join(filled, "column_name")


query("D13_sample_keys", """
SELECT 'pk_lineitem' AS constraint_name, l_orderkey || ',' || l_linenumber AS key, count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber
 HAVING count(*) > 1 ORDER BY n DESC, key LIMIT 10""")(
    lambda spark, sf_dir: constraints.violating_keys(
        constraints.repeated_keys(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_linenumber"), "pk_lineitem", ["l_orderkey", "l_linenumber"]))
