"""Operators that write and read back: sinks, stored summaries, documents and streams.

Everything is written under the shared work folder, in a new path per run.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import catalog, token_search
from ..operators.inventory import partition_stats
from ..operators.skew import stored
from ..plans import analytics, pipeline, reporting, upkeep
from ..plans.staging import STAGING
from ..session import fresh_path
from ..sources import metadata_docs, retail, sinks, tables
from ..sources.retail import table
from ..streaming import append, refresh
from ..types import RAW_SCHEMAS, SECTION_SCHEMAS
from .layers_sql import MONEY_COLUMNS, with_layers
from .pipeline import AS_OF, SEGMENT_DAILY_SQL, mart, staged
from .registry import query
from .relational import _TOKENS_SQL

C = F.col

_C360_SQL = with_layers("SELECT * EXCLUDE (revenue_units) FROM customer_360", "customer_360")
_STG_ORDERS_SQL = "SELECT * REPLACE ({}) FROM stg_orders".format(
    ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in MONEY_COLUMNS["orders"]))


@query("S2_declared_schema", with_layers("SELECT * FROM raw_payments", "raw:payments"))
def declared_schema(spark, sf_dir):
    path = fresh_path(spark, "payments-csv")
    retail.raw(spark, sf_dir, "payments").write.option("nullValue", "\\N").csv(path)
    return tables.read_raw(spark, "payments", path, "csv", nullValue="\\N")


for _id in ("S3_full_refresh", "R5_refresh_customer_segments"):
    @query(_id, _C360_SQL)
    def full_refresh(spark, sf_dir):
        path = fresh_path(spark, "customer-360")
        for _ in range(2):  # the second run replaces the first
            pipeline.refresh_customer_segments(staged(spark, sf_dir, "customers"), staged(spark, sf_dir, "orders"), path, AS_OF)
        return spark.read.parquet(path)


@query("S4_scheduled_snapshot", SEGMENT_DAILY_SQL)
def scheduled_snapshot(spark, sf_dir):
    path = fresh_path(spark, "segment-daily")
    pipeline.refresh_segment_snapshot(mart(spark, sf_dir, "customer_360"), path, AS_OF)
    return spark.read.parquet(path)


def _orders_by_month(spark: SparkSession, sf_dir: str) -> str:
    path = fresh_path(spark, "orders-by-month")
    return sinks.write_partitioned(upkeep.with_month(staged(spark, sf_dir, "orders")), path, "order_month")


_MONTH = "coalesce(strftime(order_date, '%Y-%m'), 'undated') AS order_month"

query("S5_partitioned_table", with_layers(
    f"SELECT *, {_MONTH} FROM ({_STG_ORDERS_SQL})", "orders"))(
    lambda spark, sf_dir: spark.read.parquet(_orders_by_month(spark, sf_dir)))

query("S7_guarded_read", with_layers(f"""
SELECT * FROM (SELECT order_id, total_amount, {_MONTH} FROM ({_STG_ORDERS_SQL})) WHERE order_month BETWEEN '1996-03' AND '1998-02'""", "orders"))(
    lambda spark, sf_dir: tables.read_partitioned(
        spark, _orders_by_month(spark, sf_dir), "order_month", "order_month BETWEEN '1996-03' AND '1998-02'"
    ).select("order_id", "total_amount", "order_month"))


@query("S6_clustered_table", with_layers("SELECT * FROM order_fulfillment", "order_fulfillment"))
def clustered_table(spark, sf_dir):
    path = fresh_path(spark, "fulfilment-clustered")
    return spark.read.parquet(sinks.write_clustered(
        stored(mart(spark, sf_dir, "order_fulfillment"), "fulfilment-plain"), path, "order_status", "payment_method"))


@query("S8_logical_view", with_layers("""
SELECT customer_segment, count(*) AS customer_count FROM customer_360 GROUP BY 1""", "customer_360"))
def logical_view(spark, sf_dir):
    tables.register_view("v_customer_segments", lambda: reporting.customer_segments(mart(spark, sf_dir, "customer_360")))
    return spark.sql("SELECT customer_segment, customer_count FROM v_customer_segments")


# --- metadata documents -------------------------------------------------------------------------

def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document per customer: a dataset, one or two tables, options and name-based findings."""
    c, n = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    dataset = F.concat(F.lit("raw_"), F.lower("c_mktsegment"))
    key = F.concat(F.lit("t"), C("c_custkey"))
    routine = F.concat(F.lit("refresh_"), C("c_custkey"))
    ident = [C("c_name").alias("project_id"), dataset.alias("dataset_id")]
    named = [*ident, key.alias("table_name")]
    fields = F.array(
        F.struct(F.lit("email").alias("name"), F.lit("STRING").alias("field_type"), F.lit("NULLABLE").alias("mode"),
                 F.array().cast("array<struct<name:string,field_type:string,mode:string>>").alias("fields")),
        F.struct(F.lit("home").alias("name"), F.lit("RECORD").alias("field_type"), F.lit("REPEATED").alias("mode"),
                 F.array(F.struct(F.lit("city").alias("name"), F.lit("STRING").alias("field_type"),
                                  F.lit("NULLABLE").alias("mode"))).alias("fields")))

    def one_table(kind, rows):
        return F.struct(*named, F.lit(kind).alias("table_type"), rows.alias("num_rows"),
                        (rows * 1000).alias("num_bytes"),
                        F.create_map(F.lit("pii"), F.when(C("c_acctbal") < 0, "true").otherwise("false")).alias("labels"),
                        fields.alias("schema_fields"))
    found = F.struct(dataset.alias("dataset_id"), key.alias("table_name"), F.lit("email").alias("column_name"),
                     F.lit("Email Address").alias("pii_classification"), F.lit("high").alias("confidence"))
    option = lambda name, value: F.struct(*named, F.lit(name).alias("option_name"), value.alias("option_value"))
    column = lambda name, pos: F.struct(
        *named, F.lit(name).alias("column_name"), F.lit(pos).cast("long").alias("ordinal_position"))
    path = lambda col, p: F.struct(
        *named, F.lit(col).alias("column_name"), F.lit(p).alias("field_path"), C("n_name").alias("description"))
    return c.join(n, c.c_nationkey == n.n_nationkey, "left").select(
        F.struct(C("c_name").alias("project_id")).alias("extraction_metadata"),
        F.array(F.struct(*ident, C("n_name").alias("location"),
                         F.array(F.struct(F.lit("READER").alias("role"), F.lit("view").alias("entity_type"),
                                          C("n_name").alias("entity_id"))).alias("access_entries"))).alias("datasets"),
        F.when(C("c_acctbal") >= 0, F.array(one_table("BASE TABLE", C("c_custkey")), one_table("VIEW", F.lit(0).cast("long"))))
         .otherwise(F.array(one_table("BASE TABLE", C("c_custkey")))).alias("tables"),
        F.array(column("email", 1), column("home", 2)).alias("columns"),
        F.array(path("email", "email"), path("home", "home"), path("home", "home.city")).alias("column_field_paths"),
        F.when(C("c_acctbal") >= 0, F.array(F.struct(
            *ident, key.alias("view_name"), F.concat(F.lit("SELECT "), C("c_custkey")).alias("view_definition")))
        ).alias("views"),
        F.array(option("owner", C("c_mktsegment")), option("zone", C("n_name"))).alias("table_options"),
        F.array(F.struct(*ident, routine.alias("routine_name"), F.lit("PROCEDURE").alias("routine_type"),
                         F.concat(F.lit("CALL "), C("c_custkey")).alias("routine_definition"))).alias("routines"),
        F.array(*[F.struct(*ident, routine.alias("routine_name"), F.lit(i + 1).cast("long").alias("ordinal_position"),
                           F.lit(name).alias("parameter_name"), F.lit(kind).alias("data_type"))
                  for i, (name, kind) in enumerate([("since", "DATE"), ("region", "STRING")])]).alias("routine_parameters"),
        F.array(F.struct(*named, F.lit("by_region").alias("policy_name"),
                         F.concat(F.lit("country = "), C("n_name")).alias("filter_predicate"))).alias("row_level_security"),
        F.array(F.struct(*ident, F.concat(key, F.lit("_snapshot")).alias("snapshot_table_name"), key.alias("base_table_name"),
                         F.lit("2024-06-01T00:00:00").alias("snapshot_time"))).alias("snapshots"),
        F.when(C("c_acctbal") >= 0, F.array(F.struct(
            *ident, key.alias("view_name"), F.lit("2024-06-02T00:00:00").alias("last_refresh_time")))).alias("materialized_views"),
        F.array(F.struct(F.concat(F.lit("refresh "), key).alias("name"), C("c_name").alias("config_id"),
                         dataset.alias("destination_dataset"), F.lit("every 24 hours").alias("schedule"),
                         (C("c_acctbal") < 0).alias("disabled"), F.lit("SUCCEEDED").alias("state"),
                         (C("c_acctbal") < 0).alias("schedule_options_disable_auto_scheduling"))).alias("scheduled_queries"),
        F.when(C("c_acctbal") < 0, F.array(found)).otherwise(F.array().cast(
            "array<struct<dataset_id:string,table_name:string,column_name:string,pii_classification:string,confidence:string>>")
        ).alias("pii_classification"),
        F.struct(F.array(F.struct(key.alias("upstream"), C("n_name").alias("downstream"), F.lit("copy").alias("transform"))
                         ).alias("table_lineage")).alias("lineage"))


def _stored_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = metadata_docs.write_documents(_documents(spark, sf_dir), fresh_path(spark, "documents-json"))
    return metadata_docs.read_documents(spark, path, multi_line=False)


_DOC_TABLE_SQL = """SELECT 'raw_' || lower(c_mktsegment) AS dataset_id, 't' || c_custkey AS table_name, kind AS table_type,
 CASE kind WHEN 'VIEW' THEN 0 ELSE c_custkey END AS num_rows, CASE WHEN c_acctbal < 0 THEN 'true' ELSE 'false' END AS pii
 FROM customer, (VALUES ('BASE TABLE'), ('VIEW')) AS k(kind) WHERE kind = 'BASE TABLE' OR c_acctbal >= 0"""


@query("S9_section_tables", _DOC_TABLE_SQL)
def section_tables(spark, sf_dir):
    paths = metadata_docs.write_sections(_stored_documents(spark, sf_dir), fresh_path(spark, "sections"), ["tables"])
    return spark.read.parquet(paths["tables"]).select(
        "dataset_id", "table_name", "table_type", "num_rows", C("labels")["pii"].alias("pii"))


query("S10_metadata_documents", f"""
SELECT t.dataset_id, t.table_name, t.table_type, f.pos AS ordinal_position, f.path AS field_path, f.ft AS field_type
 FROM ({_DOC_TABLE_SQL}) t, (VALUES (CAST(1 AS BIGINT), 'email', 'STRING'), (2, 'home', 'RECORD'), (2, 'home.city', 'STRING')) AS f(pos, path, ft)
""".replace("t.table_type, ", ""))(
    lambda spark, sf_dir: metadata_docs.schema_fields(_stored_documents(spark, sf_dir)).drop("mode"))

_CUSTOMER_NATION = "FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey"


@query("D22_typed_registries", f"""
SELECT 'datasets' AS section, c_name AS project_id, 'raw_' || lower(c_mktsegment) AS dataset_id, n_name AS detail {_CUSTOMER_NATION}
 UNION ALL SELECT 'views', c_name, 'raw_' || lower(c_mktsegment), 'SELECT ' || c_custkey FROM customer WHERE c_acctbal >= 0
 UNION ALL SELECT 'table_options', c_name, 'raw_' || lower(c_mktsegment), CASE o WHEN 'owner' THEN c_mktsegment ELSE n_name END
 {_CUSTOMER_NATION}, (SELECT unnest(['owner', 'zone']) AS o)
 UNION ALL SELECT 'routines', c_name, 'raw_' || lower(c_mktsegment), 'PROCEDURE' FROM customer
 UNION ALL SELECT 'routine_parameters', c_name, 'raw_' || lower(c_mktsegment), p FROM customer, (SELECT unnest(['since', 'region']) AS p)
 UNION ALL SELECT 'row_level_security', c_name, 'raw_' || lower(c_mktsegment), 'country = ' || n_name {_CUSTOMER_NATION}
 UNION ALL SELECT 'snapshots', c_name, 'raw_' || lower(c_mktsegment), '2024-06-01T00:00:00' FROM customer
 UNION ALL SELECT 'materialized_views', c_name, 'raw_' || lower(c_mktsegment), '2024-06-02T00:00:00' FROM customer WHERE c_acctbal >= 0
 UNION ALL SELECT 'scheduled_queries', c_name, 'raw_' || lower(c_mktsegment), CASE WHEN c_acctbal < 0 THEN 'disabled' ELSE 'every 24 hours' END
  FROM customer""")
def typed_registries(spark, sf_dir):
    docs = _stored_documents(spark, sf_dir)
    out = None
    details = {"datasets": "location", "views": "view_definition", "table_options": "option_value",
               "routines": "routine_type", "routine_parameters": "parameter_name", "row_level_security": "filter_predicate",
               "snapshots": "snapshot_time", "materialized_views": "last_refresh_time"}
    for name, detail in details.items():
        assert detail in SECTION_SCHEMAS[name].names
        one = metadata_docs.section(docs, name).select(
            F.lit(name).alias("section"), "project_id", "dataset_id", C(detail).alias("detail"))
        out = one if out is None else out.unionByName(one)
    scheduled = metadata_docs.section(docs, "scheduled_queries").select(
        F.lit("scheduled_queries").alias("section"), C("config_id").alias("project_id"), C("destination_dataset").alias("dataset_id"),
        F.when(C("disabled") & C("schedule_options_disable_auto_scheduling"), "disabled").otherwise(C("schedule")).alias("detail"))
    return out.unionByName(scheduled)


_COVERED = {"datasets": 1, "columns": 2, "column_field_paths": 3, "table_options": 2, "lineage.table_lineage": 1, "routines": 1,
            "routine_parameters": 2, "row_level_security": 1, "snapshots": 1, "scheduled_queries": 1}


def _coverage_sql() -> str:
    def count(name: str) -> str:
        if name in _COVERED:
            return f"(SELECT {_COVERED[name]} * count(*) FROM customer)"
        if name == "tables":
            return f"(SELECT count(*) FROM ({_DOC_TABLE_SQL}))"
        if name == "pii_classification":
            return "(SELECT count(*) FROM customer WHERE c_acctbal < 0)"
        if name in ("views", "materialized_views"):
            return "(SELECT count(*) FROM customer WHERE c_acctbal >= 0)"
        return "0"
    rows = ", ".join(f"({i + 1}, '{n}', {count(n)})" for i, n in enumerate(catalog.COVERAGE_SECTIONS))
    return f"""SELECT CAST(o AS BIGINT) AS ordinal, section, CAST(n AS BIGINT) AS records,
 CASE WHEN n > 0 THEN 'populated' ELSE 'empty' END AS status FROM (VALUES {rows}) AS v(o, section, n)"""


for _id in ("D21_coverage", "A16_section_counts"):
    query(_id, _coverage_sql())(
        lambda spark, sf_dir: catalog.coverage_report(catalog.section_counts(_stored_documents(spark, sf_dir))))
query("D21_coverage_summary", f"SELECT count(*) AS sections, count(*) FILTER (WHERE records > 0) AS populated FROM ({_coverage_sql()})")(
    lambda spark, sf_dir: catalog.coverage_summary(catalog.section_counts(_stored_documents(spark, sf_dir))))


@query("J5_table_details", f"""
SELECT 'raw_' || lower(c_mktsegment) AS dataset_id, 't' || c_custkey AS table_name, col AS column_name, n_name AS description,
 CAST(2 AS BIGINT) AS option_count, CASE WHEN c_acctbal >= 0 THEN 'SELECT ' || c_custkey END AS view_definition
 {_CUSTOMER_NATION}, (SELECT unnest(['email', 'home']) AS col)""")
def table_details(spark, sf_dir):
    docs = _stored_documents(spark, sf_dir)
    s = lambda n: metadata_docs.section(docs, n)
    return catalog.table_details(s("columns"), s("column_field_paths"), s("table_options"), s("views")).select(
        "dataset_id", "table_name", "column_name", "description", "option_count", "view_definition")


# --- stored summaries, snapshots, retention -----------------------------------------------------

_SUMMARY_SQL = with_layers("""
SELECT order_date, gross_revenue AS total_revenue, order_count, unique_customers, net_revenue, avg_order_value FROM revenue_daily""",
                           "revenue_daily")


@query("M1_daily_summary", _SUMMARY_SQL)
def daily_summary(spark, sf_dir):
    """Built from the standard shipments alone, then refreshed for the months the express orders touch."""
    orders = staged(spark, sf_dir, "orders")
    path = fresh_path(spark, "daily-summary")
    upkeep.build_daily_summary(orders.where(C("shipping_method") == "standard"), path)
    upkeep.refresh_daily_summary(orders, orders.where(C("shipping_method") == "express"), path)
    return upkeep.read_daily_summary(spark, path)


@query("M2_snapshot", with_layers("""
SELECT 'noon' AS read_at, * EXCLUDE (revenue_units) FROM customer_360 WHERE customer_segment = 'VIP'
 UNION ALL SELECT 'night', * EXCLUDE (revenue_units) FROM customer_360""", "customer_360"))
def snapshot(spark, sf_dir):
    """Two snapshots of one day, one retaken; each is read as of an instant after it."""
    root = fresh_path(spark, "snapshots")
    c360 = mart(spark, sf_dir, "customer_360")
    morning, evening = dt.datetime(2026, 2, 5, 8), dt.datetime(2026, 2, 5, 20)
    for _ in range(2):
        upkeep.snapshot_table(c360.where(C("customer_segment") == "VIP"), "customer_360", root, morning)
    upkeep.snapshot_table(c360, "customer_360", root, evening)
    at = lambda name, hour, day=5: upkeep.read_snapshot(
        spark, f"{root}/snapshot_registry", "customer_360", dt.datetime(2026, 2, day, hour)).select(F.lit(name).alias("read_at"), "*")
    return at("noon", 12).unionByName(at("night", 2, 6))


query("M3_retention", "SELECT * FROM orders WHERE o_orderdate > TIMESTAMP '1998-12-31' - INTERVAL 90 DAY")(
    lambda spark, sf_dir: upkeep.retained(table(spark, sf_dir, "orders"), "o_orderdate", dt.datetime(1998, 12, 31)))


@query("M3_expired_partitions", """
SELECT * EXCLUDE (o_orderdate), CAST(date_trunc('year', o_orderdate) AS DATE) AS order_year FROM orders
 WHERE date_trunc('year', o_orderdate) >= DATE '1998-12-31' - 90""")
def expired_partitions(spark, sf_dir):
    path = fresh_path(spark, "orders-by-year")
    dated = table(spark, sf_dir, "orders").withColumn("order_year", F.trunc("o_orderdate", "year")).drop("o_orderdate")
    sinks.write_partitioned(dated, path, "order_year")
    sinks.drop_expired_partitions(spark, path, "order_year", dt.date(1998, 12, 31), 90)
    return spark.read.parquet(path)


@query("M4_staged_orders", with_layers(_STG_ORDERS_SQL, "orders"))
def staged_orders(spark, sf_dir):
    path = upkeep.store_staged_orders(staged(spark, sf_dir, "orders"), fresh_path(spark, "staged-orders"), "order_month")
    return spark.read.parquet(path).drop("order_month")


# File sizes and times are not visible to SQL.
query("D9_partition_files")(lambda spark, sf_dir: partition_stats(
    spark.read.parquet(_orders_by_month(spark, sf_dir)), C("order_month")))


# --- streams ------------------------------------------------------------------------------------

def _streamed_events(spark: SparkSession, sf_dir: str) -> str:
    """Events arriving in four slices of event ids, one file and micro-batch each."""
    events = table(spark, sf_dir, "events")
    arrivals, sink, state = (fresh_path(spark, n) for n in ("events-arriving", "events-landed", "events-checkpoint"))
    events.repartitionByRange(4, "event_id").write.parquet(arrivals)
    stream = append.read_arrivals(spark, arrivals, events.schema, "parquet", files_per_batch=1)
    append.append_stream(stream, sink, state).awaitTermination()
    return sink


for _id in ("T1_stream_append", "S11_incremental_append"):
    query(_id, "SELECT * FROM events")(lambda spark, sf_dir: spark.read.parquet(_streamed_events(spark, sf_dir)))

query("T2_buffer_stats", """SELECT count(*) AS estimated_rows, min(ts) AS oldest_entry_time,
 count(*) > 0 AS has_bytes, true AS one_file_per_slice FROM events""")(
    lambda spark, sf_dir: _buffer_stats(spark, _streamed_events(spark, sf_dir)))


def _buffer_stats(spark: SparkSession, sink: str) -> DataFrame:
    """Bytes differ from run to run; what must hold of them is checked: they are the sizes of the four landed files."""
    landed = spark.read.parquet(sink)
    sizes = landed.groupBy("_metadata.file_path").agg(F.max("_metadata.file_size").alias("size")).collect()  # one row per slice
    return append.buffer_stats(landed, "ts").select(
        "estimated_rows", "oldest_entry_time", (C("estimated_bytes") == sum(r["size"] for r in sizes)).alias("has_bytes"),
        F.lit(len(sizes) == 4).alias("one_file_per_slice"))


def _arrive(df: DataFrame, slices: int, path: str, run: Callable[[], StreamingQuery]) -> None:
    """Write the orders slice by slice, each from as many tasks as the source has, and let the stream take each as a batch."""
    number = F.pmod(F.xxhash64("order_id"), F.lit(slices))
    for k in range(slices):
        df.where(number == k).write.mode("append").parquet(path)
        run().awaitTermination()


def _streamed_summary(spark: SparkSession, sf_dir: str, slices: int) -> DataFrame:
    arrivals, landing, summary, state = (fresh_path(spark, n) for n in ("orders-arriving", "orders-landed", "summary", "orders-checkpoint"))
    _arrive(retail.raw(spark, sf_dir, "orders"), slices, arrivals, lambda: refresh.keep_daily_summary(
        append.read_arrivals(spark, arrivals, RAW_SCHEMAS["orders"], "parquet"), landing, summary, state))
    return upkeep.read_daily_summary(spark, summary)


# Three micro-batches that touch the same months, and one scheduled run over everything that arrived.
query("T3_stream_refresh", _SUMMARY_SQL)(lambda spark, sf_dir: _streamed_summary(spark, sf_dir, 3))
query("T4_scheduled_refresh", _SUMMARY_SQL)(lambda spark, sf_dir: _streamed_summary(spark, sf_dir, 1))


@query("T3_stream_customers", _C360_SQL)
def stream_customers(spark, sf_dir):
    """New orders refresh the marts' customer buckets; customers without orders come from the first build."""
    customers = STAGING["customers"](retail.raw(spark, sf_dir, "customers"))
    path, state, arrivals, landing = (fresh_path(spark, n) for n in ("c360", "c360-checkpoint", "orders-new", "orders-kept"))
    build = lambda c, o: analytics.customer_360(c, o, AS_OF)
    orders = staged(spark, sf_dir, "orders")
    first = build(customers, orders.limit(0)).withColumn("bucket", refresh.customer_bucket(16))
    sinks.write_partitioned(first, path, "bucket")
    _arrive(orders, 3, arrivals, lambda: refresh.keep_customer_360(
        append.read_arrivals(spark, arrivals, orders.schema, "parquet"), landing, lambda: customers, build, path, state, 16))
    return spark.read.parquet(path).drop("bucket")


@query("P13_stored_token_search", f"""
SELECT doc_id FROM ({_TOKENS_SQL}) WHERE token IN ('en', 'src1', 'the') GROUP BY 1 HAVING count(DISTINCT token) = 3""")
def stored_token_search(spark, sf_dir):
    path = token_search.write_token_table(table(spark, sf_dir, "documents"), "doc_id", fresh_path(spark, "tokens"), 16)
    return token_search.search_tokens(spark.read.parquet(path), "doc_id", "The en, SRC1", 16)
