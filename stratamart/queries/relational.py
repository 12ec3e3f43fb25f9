"""S1, P1-P14, J1-J3, A1-A12, W1, O1-O4 and U1 over the star-schema tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.display import layer_of
from ..operators import predicates, token_search
from ..operators.dedup import latest_per_key
from ..operators.policy import EVERYONE, RowPolicy, apply_row_policies
from ..plans.analytics import shipping_milestones
from ..sources.retail import table
from .layers_sql import with_layers
from .pipeline import mart, staged
from .registry import query

C = F.col
MONEY = "decimal(18,2)"


def t(name, build):
    return lambda spark, sf_dir: build(table(spark, sf_dir, name))


def money(c):
    return C(c).cast(MONEY)


def dsum(c):
    """Exact sum of cents, as a check-SQL expression."""
    return f"CAST(sum(CAST({c} AS DECIMAL(15,2))) AS DOUBLE)"


query("S1_scan", "SELECT * REPLACE (CAST(s_nationkey AS BIGINT) AS s_nationkey) FROM supplier")(t("supplier", lambda d: d))
query("P1_projection", "SELECT p_partkey, p_retailprice AS current_price, 'USD' AS unit FROM part")(
    t("part", lambda d: d.select("p_partkey", C("p_retailprice").alias("current_price"), F.lit("USD").alias("unit"))))
query("P2_drop_column", "SELECT * EXCLUDE (l_linestatus) REPLACE (CAST(l_linenumber AS BIGINT) AS l_linenumber) FROM lineitem")(t("lineitem", lambda d: d.drop("l_linestatus")))
query("P3_in_list", "SELECT * FROM orders WHERE o_orderstatus IN ('F', 'O')")(
    t("orders", lambda d: d.where(C("o_orderstatus").isin("F", "O"))))
query("P5_null_predicates", with_layers("""
SELECT count(*) FILTER (WHERE customer_id IS NULL) AS guests, count(*) FILTER (WHERE order_date IS NOT NULL) AS dated,
 count(*) AS total FROM stg_orders""", "orders"))(
    lambda spark, sf_dir: staged(spark, sf_dir, "orders").agg(
        F.count_if(C("customer_id").isNull()).alias("guests"), F.count_if(C("order_date").isNotNull()).alias("dated"),
        F.count("*").alias("total")))
query("P8_search", """
SELECT doc_id, lang, source FROM documents WHERE contains(lower(text), 'the ') OR contains(lower(source), 'src1')""")(
    t("documents", lambda d: d.where(predicates.contains_ignoring_case(C("text"), "THE ") | predicates.contains_ignoring_case(C("source"), "SRC1"))
      .select("doc_id", "lang", "source")))
query("P8_search_columns", """
SELECT c_custkey FROM customer WHERE contains(lower(c_name), '12') OR contains(lower(c_mktsegment), '12')
 OR contains(CAST(c_nationkey AS VARCHAR), '12')""")(
    t("customer", lambda d: predicates.search(
        d.withColumn("nation", C("c_nationkey").cast("string")), "12", "c_name", "c_mktsegment", "nation").select("c_custkey")))
query("P10_layers", """
SELECT event_id, CASE event_type WHEN 'view' THEN 'reporting' WHEN 'click' THEN 'raw' WHEN 'signup' THEN 'staging'
 WHEN 'purchase' THEN 'analytics' ELSE 'unknown' END AS layer FROM events""")(
    t("events", lambda d: d.select("event_id", layer_of(
        F.when(C("event_type") == "view", "x_reporting").when(C("event_type") == "click", "raw_ecommerce")
        .when(C("event_type") == "signup", "my_staging_x").when(C("event_type") == "purchase", "analytics")
        .otherwise("scratch")).alias("layer"))))
query("P14_derived_table", """
SELECT * EXCLUDE (net) REPLACE (CAST(l_linenumber AS BIGINT) AS l_linenumber) FROM (SELECT *, CAST(l_extendedprice AS DECIMAL(15,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS net FROM lineitem)
 WHERE net > 50000""")(
    t("lineitem", lambda d: d.withColumn("net", money("l_extendedprice") * (1 - C("l_discount").cast("decimal(4,2)")))
      .where(C("net") > 50000).drop("net")))

_POLICIES = [RowPolicy("vip_only", (EVERYONE,), "customer_segment = 'VIP'"),
             RowPolicy("data_team", ("serviceAccount:data",), "TRUE")]
_POLICY_SQL = "SELECT customer_id, customer_segment FROM customer_360"
for _who, _where in (("analyst", " WHERE customer_segment = 'VIP'"), ("data_team", "")):
    query(f"P12_row_policy_{_who}", with_layers(_POLICY_SQL + _where, "customer_360"))(
        lambda spark, sf_dir, who=_who: apply_row_policies(
            mart(spark, sf_dir, "customer_360"), "serviceAccount:data" if who == "data_team" else "user:ann",
            _POLICIES).select("customer_id", "customer_segment"))

_TOKENS_SQL = r"""SELECT doc_id, unnest(list_distinct(string_split_regex(lower(concat_ws(' ', text, lang, source)), '[^\p{L}\p{N}]+'))) AS token FROM documents"""
query("P13_token_table", f"SELECT token, count(*) AS documents FROM ({_TOKENS_SQL}) WHERE token <> '' GROUP BY 1")(
    t("documents", lambda d: token_search.tokens(d, "doc_id").groupBy("token").agg(F.count("*").alias("documents"))))
query("P13_token_search", f"""
SELECT doc_id FROM ({_TOKENS_SQL}) WHERE token IN ('en', 'src1', 'the') GROUP BY 1 HAVING count(DISTINCT token) = 3""")(
    t("documents", lambda d: token_search.search_tokens(token_search.tokens(d, "doc_id"), "doc_id", "The en, SRC1")))


# --- joins --------------------------------------------------------------------------------------

@query("J1_left_join", """
SELECT c_custkey, c_mktsegment, o_orderkey, o_totalprice FROM customer LEFT JOIN orders
 ON c_custkey = o_custkey AND o_orderstatus = 'P' AND o_orderpriority = '1-URGENT'""")
def left_join(spark, sf_dir):
    o = table(spark, sf_dir, "orders").where((C("o_orderstatus") == "P") & (C("o_orderpriority") == "1-URGENT"))
    c = table(spark, sf_dir, "customer")
    return c.join(o, c.c_custkey == o.o_custkey, "left").select("c_custkey", "c_mktsegment", "o_orderkey", "o_totalprice")


@query("J2_chained_left_joins", """
SELECT p_partkey, l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_quantity, o_custkey FROM part LEFT JOIN lineitem ON p_partkey = l_partkey
 LEFT JOIN orders ON l_orderkey = o_orderkey""")
def chained_left_joins(spark, sf_dir):
    p, li, o = (table(spark, sf_dir, n) for n in ("part", "lineitem", "orders"))
    return (p.join(li, p.p_partkey == li.l_partkey, "left").join(o, li.l_orderkey == o.o_orderkey, "left")
            .select("p_partkey", "l_orderkey", "l_linenumber", "l_quantity", "o_custkey"))


@query("J3_reduced_fan_out", """
SELECT o_orderkey, min(l_shipdate) FILTER (WHERE l_returnflag = 'A') AS first_a,
 min(l_shipdate) FILTER (WHERE l_returnflag = 'R') AS first_r FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1""")
def reduced_fan_out(spark, sf_dir):
    o, li = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    first = li.groupBy("l_orderkey").agg(*[
        F.min(F.when(C("l_returnflag") == f, C("l_shipdate"))).alias(f"first_{f.lower()}") for f in "AR"])
    return o.join(first, o.o_orderkey == first.l_orderkey, "left").select("o_orderkey", "first_a", "first_r")


# --- aggregates ---------------------------------------------------------------------------------

query("A1_group_by", "SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY 1, 2")(
    t("lineitem", lambda d: d.groupBy("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"))))
query("A2_global", f"SELECT {dsum('l_extendedprice')} AS total, count(*) AS n FROM lineitem")(
    t("lineitem", lambda d: d.agg(F.sum(money("l_extendedprice")).alias("total"), F.count("*").alias("n"))))
query("A3_count", "SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1")(
    t("orders", lambda d: d.groupBy("o_orderpriority").agg(F.count("*").alias("n"))))
query("A4_count_distinct", """
SELECT l_returnflag, count(DISTINCT l_orderkey) AS orders, count(DISTINCT l_partkey) AS parts, count(DISTINCT l_suppkey) AS suppliers
 FROM lineitem GROUP BY 1""")(
    t("lineitem", lambda d: d.groupBy("l_returnflag").agg(
        F.count_distinct("l_orderkey").alias("orders"), F.count_distinct("l_partkey").alias("parts"),
        F.count_distinct("l_suppkey").alias("suppliers"))))
query("A5_sum", f"SELECT o_custkey, {dsum('o_totalprice')} AS revenue FROM orders GROUP BY 1")(
    t("orders", lambda d: d.groupBy("o_custkey").agg(F.sum(money("o_totalprice")).alias("revenue"))))
query("A6_avg", """
SELECT o_orderstatus, round(avg(o_totalprice), 4) AS price, round(avg(o_custkey), 4) AS key FROM orders GROUP BY 1""")(
    t("orders", lambda d: d.groupBy("o_orderstatus").agg(
        F.round(F.avg("o_totalprice"), 4).alias("price"), F.round(F.avg("o_custkey"), 4).alias("key"))))
query("A7_min_max", """
SELECT lang, min(n_chars) AS shortest, max(n_chars) AS longest, min(length(text)) AS least, max(length(text)) AS most,
 min(source) AS first_source FROM documents GROUP BY 1""")(
    t("documents", lambda d: d.groupBy("lang").agg(
        F.min("n_chars").alias("shortest"), F.max("n_chars").alias("longest"), F.min(F.length("text")).alias("least"),
        F.max(F.length("text")).alias("most"), F.min("source").alias("first_source"))))
query("A8_stddev", "SELECT event_type, round(stddev_samp(value), 6) AS sd FROM events GROUP BY 1")(
    t("events", lambda d: d.groupBy("event_type").agg(F.round(F.stddev_samp("value"), 6).alias("sd"))))
query("A9_count_if", """
SELECT user_id, count(*) FILTER (WHERE event_type = 'purchase') AS bought, count(*) FILTER (WHERE event_type = 'none') AS none
 FROM events GROUP BY 1""")(
    t("events", lambda d: d.groupBy("user_id").agg(
        F.count_if(C("event_type") == "purchase").alias("bought"), F.count_if(C("event_type") == "none").alias("none"))))
query("A10_pivot", with_layers("""
SELECT order_id, min(CASE WHEN event_type = 'picked_up' THEN event_timestamp END) AS picked_up_at,
 min(CASE WHEN event_type = 'delivered' THEN event_timestamp END) AS delivered_at,
 min(CASE WHEN event_type = 'returned' THEN event_timestamp END) AS returned_at
 FROM stg_shipping_events GROUP BY 1""", "shipping_events"))(
    lambda spark, sf_dir: shipping_milestones(staged(spark, sf_dir, "shipping_events")))
query("A11_aggregate_arithmetic", """
SELECT l_suppkey, CAST(sum(CAST(l_extendedprice AS DECIMAL(15,2))) - sum(CAST(l_quantity AS BIGINT) * CAST(l_tax AS DECIMAL(4,2))) AS DOUBLE) AS net
 FROM lineitem GROUP BY 1""")(
    t("lineitem", lambda d: d.groupBy("l_suppkey").agg(
        (F.sum(money("l_extendedprice")) - F.sum(C("l_quantity").cast("int") * C("l_tax").cast("decimal(4,2)"))).alias("net"))))
query("A12_nested_aggregate", """
SELECT o_orderstatus, round(avg(daily), 4) AS mean_of_means FROM (SELECT o_orderstatus, o_orderdate, avg(o_totalprice) AS daily
 FROM orders GROUP BY 1, 2) GROUP BY 1""")(
    t("orders", lambda d: d.groupBy("o_orderstatus", "o_orderdate").agg(F.avg("o_totalprice").alias("daily"))
      .groupBy("o_orderstatus").agg(F.round(F.avg("daily"), 4).alias("mean_of_means"))))


# --- latest row per key -------------------------------------------------------------------------

for _id in ("W1_latest_per_key", "P4_rank_filter"):
    query(_id, """
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
 WHERE rn = 1""")(t("events", lambda d: latest_per_key(d, "user_id", "ts", ["event_id"])))
query("W1_latest_line", """
SELECT * EXCLUDE (rn) REPLACE (CAST(l_linenumber AS BIGINT) AS l_linenumber) FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC,
 l_suppkey DESC, l_quantity DESC, l_extendedprice DESC, l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC) AS rn
 FROM lineitem) WHERE rn = 1""")(
    t("lineitem", lambda d: latest_per_key(d, ["l_orderkey", "l_linenumber"], "l_shipdate")))


# --- order and union ----------------------------------------------------------------------------

query("O1_order_by_aggregate", "SELECT c_mktsegment, count(*) AS customers FROM customer GROUP BY 1")(
    t("customer", lambda d: d.groupBy("c_mktsegment").agg(F.count("*").alias("customers")).orderBy(C("customers").desc())))
query("O2_order_by_columns", "SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_quantity FROM lineitem")(
    t("lineitem", lambda d: d.select("l_orderkey", "l_linenumber", "l_quantity").orderBy("l_orderkey", "l_linenumber")))
query("O4_sort_by_choice", "SELECT p_partkey, p_name, CAST(p_size AS BIGINT) AS p_size FROM part")(
    t("part", lambda d: predicates.sorted_by(d.select("p_partkey", "p_name", "p_size"), "p_name", "desc")))


@query("U1_union_all", f"""
SELECT 'Revenue' AS kpi, {dsum('o_totalprice')} AS amount, 'USD' AS unit FROM orders
 UNION ALL SELECT 'Orders', count(*), 'count' FROM orders
 UNION ALL SELECT 'Items', count(*), 'count' FROM lineitem
 UNION ALL SELECT 'Customers', count(*), 'count' FROM customer""")
def union_all(spark, sf_dir):
    def row(df, kpi, amount, unit):
        return df.agg(amount.cast("double").alias("amount")).select(
            F.lit(kpi).alias("kpi"), "amount", F.lit(unit).alias("unit"))
    o = table(spark, sf_dir, "orders").agg(F.sum(money("o_totalprice")).cast("double").alias("r"), F.count("*").cast("double").alias("n"))
    both = o.select(F.inline(F.array(
        F.struct(F.lit("Revenue").alias("kpi"), C("r").alias("amount"), F.lit("USD").alias("unit")),
        F.struct(F.lit("Orders").alias("kpi"), C("n").alias("amount"), F.lit("count").alias("unit")))))
    return (both.unionByName(row(table(spark, sf_dir, "lineitem"), "Items", F.count("*"), "count"))
            .unionByName(row(table(spark, sf_dir, "customer"), "Customers", F.count("*"), "count")))
