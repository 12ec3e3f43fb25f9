import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from stratamart import functions as fn


def one(spark, expr, **values):
    """Evaluate a column builder over a single row of literals."""
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]) if values else spark.range(1)
    return df.select(expr().alias("x")).first().x


@pytest.mark.parametrize("text, want", [
    ("12.5", D("12.500000000")), ("-3", D("-3")), (" 7 ", D("7")), ("1.0000000005", D("1.000000001")),
    ("abc", None), ("", None), (None, None)])
def test_safe_numeric(spark, text, want):
    assert one(spark, lambda: fn.safe_numeric(F.lit(text).cast("string"))) == want


@pytest.mark.parametrize("text, want", [("12", 12), ("1.5", None), ("x", None), ("99999999999999999999", None)])
def test_safe_integer(spark, text, want):
    assert one(spark, lambda: fn.safe_integer(F.lit(text))) == want


@pytest.mark.parametrize("text, want", [
    ("2024-01-05", dt.date(2024, 1, 5)), ("2024-1-5", dt.date(2024, 1, 5)), ("2024-02-30", None), ("soon", None), (None, None)])
def test_parse_date(spark, text, want):
    assert one(spark, lambda: fn.parse_date(F.lit(text).cast("string"))) == want


@pytest.mark.parametrize("text, want", [
    ("2024-01-05T10:11:12", dt.datetime(2024, 1, 5, 10, 11, 12)), ("2024-01-05", None), ("2024-01-05T25:00:00", None)])
def test_parse_timestamp(spark, text, want):
    assert one(spark, lambda: fn.parse_timestamp(F.lit(text)).cast("timestamp_ntz")) == want


@pytest.mark.parametrize("text, want", [
    ("mary-jane", "Mary-Jane"), ("o'hara", "O'hara"), ("ALL CAPS", "All Caps"), ("a.b_c/d", "A.B_C/D"), ("", ""), (None, None)])
def test_initcap(spark, text, want):
    assert one(spark, lambda: fn.initcap_delimited(F.lit(text).cast("string"))) == want


@pytest.mark.parametrize("value, want", [("12.500000000", "12.5"), ("100.000000000", "100"), ("0", "0"), ("-0.10", "-0.1")])
def test_plain_number_text(spark, value, want):
    assert one(spark, lambda: fn.plain_number_text(F.lit(D(value)))) == want


def test_decimal_helpers_keep_nine_digits(spark):
    big = D("1234567890.123456789")
    assert one(spark, lambda: fn.subtract(F.lit(big), F.lit(D("0.000000001")))) == D("1234567890.123456788")
    assert one(spark, lambda: fn.times(F.lit(2), F.lit(D("1.123456789")))) == D("2.246913578")
    assert one(spark, lambda: fn.ratio(F.lit(D("2")), F.lit(D("3")))) == D("0.666666667")
    assert one(spark, lambda: fn.ratio(F.lit(D("2")), F.lit(D("0")))) is None
    assert one(spark, lambda: fn.average_of(F.lit(D("10")), F.lit(3))) == D("3.333333333")
    assert one(spark, lambda: fn.average_of(F.lit(D("10")), F.lit(0))) is None


@pytest.mark.parametrize("months, want", [(6, D("200")), (0, D("100")), (-1, D("100")), (None, D("100")), (7, D("171.43"))])
def test_ltv(spark, months, want):
    assert one(spark, lambda: fn.calculate_ltv(F.lit(D("100")), F.lit(3), F.lit(months).cast("long"))) == want


def test_emails_and_currency(spark):
    assert one(spark, lambda: fn.clean_email(F.lit("  A@B.no "))) == "a@b.no"
    assert one(spark, lambda: fn.format_currency(F.lit(D("1234567.345")))) == "$1,234,567.35"
    assert one(spark, lambda: fn.format_currency(F.lit(D("2.345")))) == "$2.35"
    assert one(spark, lambda: fn.format_currency(F.lit(None).cast("decimal(10,2)"))) is None


@pytest.mark.parametrize("shipped, delivered, want", [
    ("2024-01-01 10:00", None, "Pending"), ("2024-01-01 10:00", "2024-01-04 09:00", "On Time"),
    ("2024-01-01 10:00", "2024-01-05 11:00", "Late"), (None, "2024-01-05 11:00", "Late"), (None, None, "Pending")])
def test_sla(spark, shipped, delivered, want):
    ts = lambda s: F.lit(s).cast("timestamp")
    assert one(spark, lambda: fn.calculate_sla_status(ts(shipped), ts(delivered), F.lit(3))) == want


@pytest.mark.parametrize("n, want", [
    (None, "0 B"), (0, "0 B"), (1, "1 B"), (1023, "1023 B"), (1024, "1 KB"), (1536, "1.5 KB"), (1048576, "1 MB"),
    (1288490189, "1.2 GB"), (5 * 1024 ** 4, "5 TB"), (5000 * 1024 ** 4, "5000 TB")])
def test_human_bytes(spark, n, want):
    assert one(spark, lambda: fn.human_bytes(F.lit(n).cast("long"))) == want


@pytest.mark.parametrize("ms, want", [(0, "0ms"), (999, "999ms"), (1000, "1.0s"), (59940, "59.9s"), (60000, "1.0m"), (90000, "1.5m")])
def test_human_duration(spark, ms, want):
    start = F.lit("2024-01-01 00:00:00").cast("timestamp")
    assert one(spark, lambda: fn.human_duration(start, F.timestamp_add("MILLISECOND", F.lit(ms), start))) == want


def test_other_display(spark):
    ts = lambda s: F.lit(s).cast("timestamp")
    assert one(spark, lambda: fn.human_duration(ts(None), ts("2024-01-01"))) == "-"
    assert one(spark, lambda: fn.human_date(ts("2024-01-05 15:07:00"))) == "Jan 5, 2024"
    assert one(spark, lambda: fn.human_datetime(ts("2024-01-05 15:07:00"))) == "Jan 5, 2024, 3:07 PM"
    assert one(spark, lambda: fn.human_date(ts(None))) == "-"
    assert one(spark, lambda: fn.iso_text(ts("2024-01-05 15:07:00"))) == "2024-01-05T15:07:00+00:00"
    assert one(spark, lambda: fn.iso_text(ts("2024-01-05 15:07:00.5"))) == "2024-01-05T15:07:00.500000+00:00"
    assert one(spark, lambda: fn.size_mb(F.lit(1572864))) == 1.5
    assert one(spark, lambda: fn.size_mb(F.lit(None).cast("long"))) == 0
    assert one(spark, lambda: fn.truncated(F.lit("abcdef"), 3)) == "abc..."
    assert one(spark, lambda: fn.truncated(F.lit("abc"), 3)) == "abc"
    assert one(spark, lambda: fn.truncated(F.lit(""), 3)) == "-"
    assert one(spark, lambda: fn.preview(F.lit(None).cast("string"))) == ""
    assert one(spark, lambda: fn.email_local_part(F.lit("a.b@c.no"))) == "a.b"
    assert one(spark, lambda: fn.last_two_parts(F.lit("a.b.c"))) == "b.c"
    assert one(spark, lambda: fn.last_two_parts(F.lit("b.c"))) == "b.c"
    assert one(spark, lambda: fn.layer_label(F.lit("raw_ecommerce"))) == "Raw"
    assert one(spark, lambda: fn.layer_of(F.lit("x_staging_raw"))) == "raw"
    assert one(spark, lambda: fn.layer_of(F.lit("other"))) == "unknown"
    assert one(spark, lambda: fn.table_kind(F.lit("BASE TABLE"))) == "TABLE"
    assert one(spark, lambda: fn.millis_to_days(F.lit(172800000))) == 2
    assert one(spark, lambda: fn.cache_rate(F.lit(1), F.lit(3))) == 33
    assert one(spark, lambda: fn.cache_rate(F.lit(0), F.lit(0))) == 0


@pytest.mark.parametrize("pct, nulls, distinct", [(0.0, "good", "warn"), (9.9, "warn", "warn"), (10.0, "bad", "warn"),
                                                  (50.0, "bad", "warn"), (50.1, "bad", "neutral"), (80.1, "bad", "good")])
def test_traffic_lights(spark, pct, nulls, distinct):
    assert one(spark, lambda: fn.null_bucket(F.lit(pct))) == nulls
    assert one(spark, lambda: fn.distinct_bucket(F.lit(pct))) == distinct


def test_datetimes_are_utc_whatever_the_machine_zone(spark):
    oslo = dt.timezone(dt.timedelta(hours=2))
    for value in (dt.datetime(2024, 5, 1, 10), dt.datetime(2024, 5, 1, 12, tzinfo=oslo)):
        assert one(spark, lambda: fn.utc_instant(value).cast("string")) == "2024-05-01 10:00:00"


def test_human_bytes_of_products_beyond_64_bits(spark, tmp_path):
    from stratamart.queries import REGISTRY
    rows = [(9_000_000, 900_000), (10 ** 15, 10 ** 15), (3, 2), (None, 1), (1, None)]
    spark.createDataFrame(rows, "o_orderkey long, o_custkey long").write.parquet(f"{tmp_path}/orders.parquet")
    got = {r.o_orderkey: r["size"] for r in REGISTRY["F21_human_bytes"].run(spark, str(tmp_path)).collect()}
    assert got == {9_000_000: "66302163.76 TB", 10 ** 15: "909494701772928300000000000000000 TB", 3: "18 B", None: "0 B", 1: "0 B"}
