"""F1-F33 and R1-R4, each over whole tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import business, casts, display, text
from ..operators.profile import quality_rows
from ..sources import retail
from ..sources.retail import table
from .layers_sql import day, initcap, instant, integer, numeric, with_layers
from .metadata import _QUALITY_SQL, _STAGED_COLUMNS, _staged_profile, bytes_sql, duration_sql, query_log
from .pipeline import AS_OF, mart
from .registry import query

C = F.col


def on_table(name: str, source: str, key: str, columns: dict, sql: str) -> None:
    """A query of ``key`` and some computed columns of one star table."""
    query(name, f"SELECT {key}, {sql} FROM {source}")(
        lambda spark, sf_dir: table(spark, sf_dir, source).select(key, *[c().alias(n) for n, c in columns.items()]))


def on_raw(name: str, source: str, key: str, columns: dict, sql: str) -> None:
    query(name, with_layers(f"SELECT {key}, {sql} FROM raw_{source}", f"raw:{source}"))(
        lambda spark, sf_dir: retail.raw(spark, sf_dir, source).select(key, *[c().alias(n) for n, c in columns.items()]))


on_raw("F1_safe_numeric", "orders", "order_id",
       {"amount": lambda: casts.safe_numeric(C("total_amount")), "bad": lambda: casts.safe_numeric(C("order_status"))},
       f"CAST({numeric('total_amount')} AS DOUBLE) AS amount, CAST(NULL AS DOUBLE) AS bad")
on_raw("F2_safe_integer", "order_items", "order_item_id",
       {"quantity": lambda: casts.safe_integer(C("quantity")), "from_price": lambda: casts.safe_integer(C("subtotal"))},
       f"{integer('quantity')} AS quantity, {integer('subtotal')} AS from_price")
on_raw("F3_safe_date", "customers", "customer_id", {"born": lambda: casts.parse_date(C("date_of_birth"))},
       f"{day('date_of_birth')} AS born")
on_raw("F4_safe_timestamp", "customers", "customer_id",
       {"created": lambda: casts.parse_timestamp(C("created_at")), "bad": lambda: casts.parse_timestamp(C("date_of_birth"))},
       f"{instant('created_at')} AS created, {instant('date_of_birth')} AS bad")
on_raw("F5_initcap", "customers", "customer_id",
       {"first_name": lambda: text.initcap_delimited(C("first_name")), "address": lambda: text.initcap_delimited(F.lower("address_line1")),
        "mail": lambda: text.initcap_delimited(C("email"))},
       f"{initcap('first_name')} AS first_name, {initcap('lower(address_line1)')} AS address, {initcap('email')} AS mail")
on_raw("F6_lower_trim", "customers", "customer_id",
       {"email": lambda: F.lower("email"), "trimmed": lambda: F.trim(F.concat(F.lit("  "), C("last_name"), F.lit(" ")))},
       "lower(email) AS email, trim('  ' || last_name || ' ') AS trimmed")
on_table("F7_case", "customer", "c_custkey",
         {"flag": lambda: F.when(F.lower("c_mktsegment") == "building", True).otherwise(False),
          "tier": lambda: F.when(C("c_acctbal") >= 5000, "high").when(C("c_acctbal") >= 0, "low").otherwise("debt")},
         "CASE lower(c_mktsegment) WHEN 'building' THEN true ELSE false END AS flag, "
         "CASE WHEN c_acctbal >= 5000 THEN 'high' WHEN c_acctbal >= 0 THEN 'low' ELSE 'debt' END AS tier")
on_raw("F8_coalesce", "payments", "payment_id", {"card": lambda: F.coalesce("card_last_four", F.lit("none"))},
       "coalesce(card_last_four, 'none') AS card")
on_table("F9_safe_divide", "customer", "c_custkey", {"per_nation": lambda: F.try_divide("c_acctbal", "c_nationkey")},
         "CASE WHEN c_nationkey <> 0 THEN c_acctbal / c_nationkey END AS per_nation")
on_table("F10_round", "orders", "o_orderkey",
         {"one": lambda: F.round(C("o_totalprice").cast("decimal(18,2)"), 1),
          "two": lambda: F.round(C("o_totalprice").cast("decimal(18,2)") * F.lit(0.125).cast("decimal(4,3)"), 2)},
         "CAST(round(CAST(o_totalprice AS DECIMAL(15,2)), 1) AS DOUBLE) AS one, "
         "CAST(round(CAST(o_totalprice AS DECIMAL(15,2)) * CAST(0.125 AS DECIMAL(4,3)), 2) AS DOUBLE) AS two")
on_table("F11_differences", "events", "event_id",
         {"days": lambda: F.date_diff(F.lit(AS_OF), F.to_date("ts")),
          "hours": lambda: F.timestamp_diff("HOUR", C("ts"), F.lit("2024-01-15 12:34:56").cast("timestamp_ntz")),
          "whole_days": lambda: F.timestamp_diff("DAY", C("ts"), F.lit("2024-01-15 12:34:56").cast("timestamp_ntz"))},
         "date_diff('day', CAST(ts AS DATE), DATE '2024-12-31') AS days, date_sub('hour', ts, TIMESTAMP '2024-01-15 12:34:56') AS hours, "
         "date_sub('day', ts, TIMESTAMP '2024-01-15 12:34:56') AS whole_days")
on_table("F12_intervals", "events", "event_id",
         {"expires": lambda: C("ts") + F.expr("INTERVAL 90 DAYS"), "before": lambda: C("ts") - F.expr("INTERVAL 7 DAYS")},
         "ts + INTERVAL 90 DAY AS expires, ts - INTERVAL 7 DAY AS before")
on_table("F13_extract", "orders", "o_orderkey",
         {"year": lambda: F.year("o_orderdate"), "month": lambda: F.month("o_orderdate"), "dow": lambda: F.dayofweek("o_orderdate")},
         "year(o_orderdate) AS year, month(o_orderdate) AS month, dayofweek(o_orderdate) + 1 AS dow")
on_table("F14_date_of", "events", "event_id", {"day": lambda: F.to_date("ts")}, "CAST(ts AS DATE) AS day")
on_raw("F15_number_text", "orders", "order_id",
       {"amount": lambda: casts.plain_number_text(casts.safe_numeric(C("total_amount"))),
        "tax": lambda: casts.plain_number_text(casts.safe_numeric(C("tax_amount")))},
       "regexp_replace(CAST({} AS VARCHAR), '[.]?0+$', '') AS amount, regexp_replace(CAST({} AS VARCHAR), '[.]?0+$', '') AS tax".format(
           numeric("total_amount"), numeric("tax_amount")))

for _id in ("F16_currency_text", "R3_format_currency"):
    on_table(_id, "customer", "c_custkey",
             {"balance": lambda: business.format_currency(C("c_acctbal")),
              "part": lambda: business.format_currency(C("c_acctbal").cast("decimal(18,2)") * F.lit(1.125).cast("decimal(4,3)"))},
             "'$' || format('{:,.2f}', c_acctbal) AS balance, "
             "'$' || format('{:,.2f}', CAST(round(CAST(c_acctbal AS DECIMAL(15,2)) * CAST(1.125 AS DECIMAL(4,3)), 2) AS DOUBLE)) AS part")

on_table("F17_length", "documents", "doc_id", {"chars": lambda: F.length("text")}, "length(text) AS chars")
on_table("F18_as_of", "events", "event_id",
         {"day": lambda: F.lit(AS_OF), "age": lambda: F.date_diff(F.lit(AS_OF), F.to_date("ts"))},
         "DATE '2024-12-31' AS day, date_diff('day', CAST(ts AS DATE), DATE '2024-12-31') AS age")
on_table("F19_text_previews", "documents", "doc_id",
         {"preview": lambda: display.preview(C("text")), "short": lambda: display.truncated(C("text"), 80)},
         "left(coalesce(text, ''), 500) AS preview, CASE WHEN text IS NULL OR text = '' THEN '-' "
         "WHEN length(text) > 80 THEN left(text, 80) || '...' ELSE text END AS short")
on_raw("F20_email_local_part", "customers", "customer_id", {"local": lambda: display.email_local_part(C("email"))},
       "split_part(email, '@', 1) AS local")
_BIG = "CAST(o_orderkey AS BIGINT) * o_orderkey * o_custkey"


def _exact_product(*names: str) -> Column:
    """Product of whole numbers beyond 64 bits; past 38 digits, where no type is exact, as a double."""
    exact = reduce(F.try_multiply, [C(n).cast("decimal(38,0)") for n in names])
    return F.coalesce(exact.cast("double"), reduce(lambda a, b: a * b, [C(n).cast("double") for n in names]))


on_table("F21_human_bytes", "orders", "o_orderkey",
         {"size": lambda: display.human_bytes(_exact_product("o_orderkey", "o_orderkey", "o_custkey")),
          "small": lambda: display.human_bytes(C("o_custkey"))},
         f"{bytes_sql(_BIG)} AS size, {bytes_sql('o_custkey')} AS small")
_END = "(ts + to_milliseconds(CAST(floor(value * value * 100) AS BIGINT)))"
on_table("F22_human_duration", "events", "event_id",
         {"took": lambda: display.human_duration(C("ts"), F.timestamp_add(
             "MILLISECOND", F.floor(C("value") * C("value") * 100), C("ts")))},
         f"{duration_sql('ts', _END)} AS took")
on_table("F23_human_dates", "events", "event_id",
         {"day": lambda: display.human_date(C("ts")), "moment": lambda: display.human_datetime(C("ts"))},
         "strftime(ts, '%b %-d, %Y') AS day, strftime(ts, '%b %-d, %Y, %-I:%M %p') AS moment")
on_table("F24_iso_text", "events", "event_id",
         {"iso": lambda: display.iso_text(C("ts")), "midnight": lambda: display.iso_text(F.date_trunc("day", "ts").cast("timestamp_ntz"))},
         "strftime(ts, '%Y-%m-%dT%H:%M:%S') || CASE WHEN epoch_us(ts) % 1000000 = 0 THEN '' ELSE strftime(ts, '.%f') END || '+00:00' AS iso, "
         "strftime(date_trunc('day', ts), '%Y-%m-%dT%H:%M:%S') || '+00:00' AS midnight")
on_table("F25_size_mb", "events", "event_id",
         {"mb": lambda: display.size_mb(F.when(C("event_type") != "error", F.floor(C("value") * 1000000)))},
         "coalesce(round(CASE WHEN event_type <> 'error' THEN floor(value * 1000000) END / 1048576.0, 4), 0) AS mb")

query("F26_percent", """
SELECT c_mktsegment, CAST(c_nationkey AS BIGINT) AS c_nationkey, round(count(*) FILTER (WHERE c_acctbal < 0) / count(*) * 100, 2) AS pct, CAST(0 AS DOUBLE) AS none
 FROM customer GROUP BY 1, 2""")(
    lambda spark, sf_dir: table(spark, sf_dir, "customer").groupBy("c_mktsegment", "c_nationkey").agg(
        display.percent_of(F.count_if(C("c_acctbal") < 0), F.count("*")).alias("pct"),
        display.percent_of(F.count("*"), F.lit(0)).alias("none")))

on_table("F27_millis_to_days", "orders", "o_orderkey", {"days": lambda: F.round(display.millis_to_days(C("o_totalprice") * 1000), 6)},
         "round(o_totalprice * 1000 / 86400000, 6) AS days")
on_table("F29_label_access", "customer", "c_custkey",
         {"is_pii": lambda: display.label_value(F.create_map(F.lit("pii"), F.when(C("c_acctbal") < 0, "true").otherwise("false"),
                                                             F.lit("owner"), C("c_mktsegment")), "pii") == "true",
          "missing": lambda: display.label_value(F.create_map(F.lit("owner"), C("c_mktsegment")), "pii")},
         "c_acctbal < 0 AS is_pii, CAST(NULL AS VARCHAR) AS missing")

query("F30_nested_flatten", """
SELECT 'job-' || event_id AS job_id, unnest(CASE event_type WHEN 'click' THEN [NULL] WHEN 'view'
 THEN ['raw.t' || json_extract_string(props, '$.k'), 'staging.s' || user_id] ELSE ['raw.t' || json_extract_string(props, '$.k')] END) AS ref
 FROM events""")(
    lambda spark, sf_dir: query_log(spark, sf_dir).select("job_id", F.explode_outer("referenced_tables").alias("r")).select(
        "job_id", F.when(C("r").isNotNull(), F.concat_ws(".", "r.dataset_id", "r.table_id")).alias("ref")))

query("F31_traffic_lights", with_layers(f"""
SELECT table_name, column_name, CASE WHEN null_pct = 0 THEN 'good' WHEN null_pct < 10 THEN 'warn' ELSE 'bad' END AS nulls,
 CASE WHEN distinct_pct > 80 THEN 'good' WHEN distinct_pct > 50 THEN 'neutral' ELSE 'warn' END AS distincts
 FROM ({_QUALITY_SQL})""", *_STAGED_COLUMNS))(
    lambda spark, sf_dir: quality_rows(_staged_profile(spark, sf_dir, figures=False)).select(
        "table_name", "column_name", display.null_bucket(C("null_pct")).alias("nulls"),
        display.distinct_bucket(C("distinct_pct")).alias("distincts")))

on_table("F32_layer_label", "part", "p_partkey",
         {"label": lambda: display.layer_label(F.concat(F.lower("p_type"), F.lit("_ecommerce"))),
          "plain": lambda: display.layer_label(C("p_name"))},
         "upper(left(p_type, 1)) || substr(lower(p_type), 2) AS label, upper(left(p_name, 1)) || substr(p_name, 2) AS plain")
on_table("F33_table_kind", "events", "event_id",
         {"kind": lambda: display.table_kind(F.when(C("event_type") == "view", "VIEW").otherwise(F.upper("event_type")))},
         "CASE WHEN event_type = 'view' THEN 'VIEW' ELSE 'TABLE' END AS kind")

_CENTS = "CAST(CAST(c_acctbal AS DECIMAL(15,2)) * 100 AS BIGINT) * 12"
on_table("R1_calculate_ltv", "customer", "c_custkey",
         {"ltv": lambda: business.calculate_ltv(C("c_acctbal").cast("decimal(18,2)"), F.lit(1), C("c_nationkey")),
          "no_months": lambda: business.calculate_ltv(C("c_acctbal").cast("decimal(18,2)"), F.lit(1), F.lit(None).cast("bigint"))},
         f"CASE WHEN c_nationkey > 0 THEN CAST(sign({_CENTS}) * ((2 * abs({_CENTS}) + c_nationkey) // (2 * c_nationkey)) AS DOUBLE) / 100 "
         "ELSE c_acctbal END AS ltv, c_acctbal AS no_months")
on_raw("R2_clean_email", "customers", "customer_id",
       {"email": lambda: business.clean_email(F.concat(F.lit(" "), C("email"), F.lit("  ")))},
       "lower(trim(' ' || email || '  ')) AS email")

query("R4_sla_status", with_layers("""
SELECT order_id, payment_method, CASE WHEN delivered_at IS NULL THEN 'Pending'
 WHEN date_sub('day', picked_up_at, delivered_at) <= 3 THEN 'On Time' ELSE 'Late' END AS sla,
 CASE WHEN delivered_at IS NULL THEN 'Pending' ELSE 'Late' END AS unshipped FROM order_fulfillment""", "order_fulfillment"))(
    lambda spark, sf_dir: mart(spark, sf_dir, "order_fulfillment").select(
        "order_id", "payment_method",
        business.calculate_sla_status(C("picked_up_at"), C("delivered_at"), F.lit(3)).alias("sla"),
        business.calculate_sla_status(F.lit(None).cast("timestamp"), C("delivered_at"), F.lit(3)).alias("unshipped")))
