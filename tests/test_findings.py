"""Values, failing columns, JSON trees, sketches, recorded layouts and column attributes."""

import pytest
from pyspark.sql import functions as F

from stratamart.operators import constraints, inventory, pii_values, profile, sketches
from stratamart.operators.specs import TableSpec
from stratamart.queries import REGISTRY
from stratamart.sources import sinks


def scan(spark, values):
    df = spark.createDataFrame([(v, 1) for v in values], "text string, n int")
    return {r.pii_classification: r for r in pii_values.scan_values(TableSpec("d", "t", df)).collect()}


def test_values_are_checked_not_only_matched(spark):
    got = scan(spark, ["pay 4111 1111 1111 1111 now", "pay 4111111111111112 now", "10.0.0.255 and 10.0.0.256", "call +47 22 22 22 22",
                       "+12 34", "078-05-1120", "000-05-1120", "666-05-1120 1-078-05-1120-1", "a.b+c@mail.example.co.uk, x@y", None, ""])
    assert {k: (r.rows_with_hits, r.hits, r.rejected) for k, r in got.items()} == {
        "Payment Card Number": (1, 1, 2), "IP Address": (1, 1, 1), "Phone Number": (1, 1, 0), "Social Security Number": (1, 1, 2),
        "Email Address": (1, 1, 0)}
    assert got["Email Address"].filled_rows == 10 and got["Email Address"].hit_rate_pct == 10.0 and got["Email Address"].confidence == "medium"


def test_confidence_goes_by_share_and_other_types_are_left(spark):
    assert scan(spark, ["a@b.example.com"] * 3 + ["x"])["Email Address"].confidence == "high"
    assert scan(spark, ["a@b.example.com"] + ["x"] * 99)["Email Address"].confidence == "low"
    assert pii_values.scan_values(TableSpec("d", "t", spark.range(3))).count() == 0
    assert scan(spark, [None]) == {}


def test_scan_reads_a_table_once(spark, sf_dir):
    spec = TableSpec("star", "documents", spark.read.parquet(f"{sf_dir}/documents.parquet"))
    plan = pii_values.scan_values(spec)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and "PythonUDF" not in plan


@pytest.mark.parametrize("bad", [0, 1, 3])
def test_failing_columns_stand_alone(spark, bad):
    columns = [F.col("id"), *[F.expr(f"cast(id * 1000 as tinyint) AS bad{i}") for i in range(bad)], *[(F.col("id") % k).alias(f"m{k}") for k in (2, 3, 5)]]
    df = spark.range(100).select(*columns)
    got = {r.column_name: r for r in profile.profile_isolated(TableSpec("d", "t", df)).collect()}
    assert len(got) == 4 + bad and [got[c].ordinal_position for c in df.columns] == list(range(1, len(df.columns) + 1))
    assert all(got[f"bad{i}"].status == "error: CAST_OVERFLOW" and got[f"bad{i}"].total_rows is None for i in range(bad))
    assert [got[f"m{k}"].distinct_count for k in (2, 3, 5)] == [2, 3, 5]


def test_other_failures_are_raised(spark, scratch):
    path = scratch("gone")
    spark.range(3).write.parquet(path)
    df = spark.read.parquet(path)
    spark.range(1).selectExpr("id", "id AS x").write.mode("overwrite").parquet(path)  # the files of the plan are no longer there
    with pytest.raises(Exception, match="(?i)not exist|FAILED_READ_FILE|not found"):
        spec = TableSpec("d", "t", df)
        if profile.profile_isolated(spec).where("status LIKE 'error%'").count():
            raise FileNotFoundError("not found: reported as a column's error")


def test_json_tree_of_any_depth(spark):
    docs = ['{"a": 1, "b": {"c": [1, "x", null, {"d": [[true]]}]}}', '{"a": null, "b": {}}', '[1, {"a": 2.5}]', '"text"', "no json", None, "null"]
    df = spark.createDataFrame([(d,) for d in docs], "j string")
    got = {(r.field_path, r.data_type): (r.n_values, r.n_null) for r in inventory.json_tree(df, "j").collect()}
    assert got == {
        ("j", "OBJECT"): (2, 1), ("j", "ARRAY"): (1, 1), ("j", "STRING"): (1, 1), ("j", "invalid"): (1, 1),
        ("j.a", "BIGINT"): (1, 1), ("j.b", "OBJECT"): (2, 0), ("j.b.c", "ARRAY"): (1, 0), ("j.b.c[]", "BIGINT"): (1, 1),
        ("j.b.c[]", "STRING"): (1, 1), ("j.b.c[]", "OBJECT"): (1, 1), ("j.b.c[].d", "ARRAY"): (1, 0), ("j.b.c[].d[]", "ARRAY"): (1, 0),
        ("j.b.c[].d[][]", "BOOLEAN"): (1, 0), ("j[]", "BIGINT"): (1, 0), ("j[]", "OBJECT"): (1, 0), ("j[].a", "DECIMAL"): (1, 0)}
    assert inventory.json_tree(df.where("false"), "j").count() == 0


def test_sketches_refresh_like_a_rebuild(spark, scratch):
    df = spark.range(20000).select((F.col("id") % 7).alias("p"), "id", (F.col("id") % 500).alias("k"),
                                   F.when(F.col("id") % 10 > 0, F.concat(F.lit("s"), F.col("id") % 3000)).alias("s"), F.array("id").alias("a"))
    part, whole = scratch("part"), scratch("whole")
    sketches.store_sketches(df.where("p <> 3 OR id < 9000"), "p", part)
    for _ in range(2):
        sketches.refresh_sketches(df, "p", [3], part)
    sketches.store_sketches(df, "p", whole)
    rows = lambda path: sorted(map(str, sketches.profile_from_sketches(spark, path).collect()))
    assert rows(part) == rows(whole)
    got = {r.column_name: r for r in sketches.profile_from_sketches(spark, part).collect()}
    for name, exact in (("id", 20000), ("k", 500), ("s", 2700), ("a", 20000)):
        assert abs(got[name].distinct_estimate - exact) <= 0.05 * exact and got[name].total_rows == 20000
    assert (got["s"].null_count, got["k"].min_number, got["k"].max_number, got["k"].mean) == (2000, 0, 499, 249.5)
    assert sketches.refresh_sketches(df, "p", [], part) == part and spark.read.parquet(part).count() == 28


def test_writers_record_their_layout(spark, scratch):
    df = spark.range(10).select("id", (F.col("id") % 2).alias("p"), (F.col("id") % 3).alias("c"))
    path = scratch("table")
    for write, want in ((lambda: sinks.write_partitioned(df, path, "p"), (["p"], [])), (lambda: sinks.write_clustered(df, path, "c", "p"), ([], ["c", "p"])),
                        (lambda: sinks.write_partitioned_clustered(df, path, "p", "c"), (["p"], ["c"])), (lambda: sinks.overwrite(df, path), ([], []))):
        write()
        layout = sinks.read_layout(spark, path)
        assert (layout["partition_columns"], layout["sort_columns"]) == want and spark.read.parquet(path).count() == 10
    spec = inventory.stored_spec(spark, "d", "t", sinks.write_partitioned_clustered(df, path, "p", "c"))
    assert spec.partition_column == "p" and spec.cluster_columns == ("c",)
    plain = scratch("plain")
    df.write.parquet(plain)
    assert sinks.read_layout(spark, plain) == {"partition_columns": [], "sort_columns": [], "buckets": None}


def test_bucketed_query_has_no_shuffle(spark, sf_dir):
    plan = REGISTRY["S6_bucketed_join"].run(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan


def test_partitions_of_all_tables(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y"), (3, None)], "n int, day string")
    specs = [TableSpec("d", "dated", a), TableSpec("d", "plain", a), TableSpec("d", "v", a, kind="VIEW")]
    parts = inventory.all_partition_stats(specs, {"dated": F.col("day")})
    assert sorted((r.table_name, r.partition_id, r.total_rows) for r in parts.collect()) == [
        ("dated", "x", 1), ("dated", "y", 1), ("plain", inventory.UNPARTITIONED, 3)]
    assert {r.table_name: (r.total_rows, r.total_partitions) for r in inventory.all_storage_stats(parts).collect()} == {"dated": (2, 2), "plain": (3, 1)}


def test_violating_keys_are_listed(spark):
    df = spark.createDataFrame([("a", 1)] * 3 + [("b", 1)] * 2 + [("c", 1), (None, 1), (None, 1)], "k string, j int")
    got = constraints.violating_keys(constraints.repeated_keys(df, "k", "j"), "pk", ["k", "j"], samples=5).collect()
    assert [(r.key, r.n) for r in got] == [("a,1", 3), ("b,1", 2)]


def test_personal_data_counts_only_the_classified_columns(spark, sf_dir):
    plan = lambda name: REGISTRY[name].run(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    for name in ("D14_pii_classification", "D15_pii_rollup"):
        assert "orders.parquet" in plan(name) and "lineitem.parquet" not in plan(name)
    assert plan("J4_membership_flag").count("FileScan parquet") == plan("D7_column_inventory").count("FileScan parquet")


def test_filled_rows(spark):
    df = spark.createDataFrame([(1, None, "x"), (None, None, "")], "`a.b` int, c string, d string")
    got = inventory.filled_rows([TableSpec("d", "t", df), TableSpec("d", "e", df.limit(0).select("d"))])
    assert sorted(map(tuple, got.collect())) == [("d", "e", "d", 0), ("d", "t", "a.b", 1), ("d", "t", "c", 0), ("d", "t", "d", 2)]


@pytest.mark.parametrize("name", ["D5_written_layout", "S6_clustered_table"])
def test_clustered_marts_are_stored_before_their_ranges_are_sampled(name, spark, sf_dir, monkeypatch):
    plans = []
    real = sinks.clustered
    monkeypatch.setattr(sinks, "clustered", lambda df, *a, **k: plans.append(df._jdf.queryExecution().executedPlan().toString()) or real(df, *a, **k))
    REGISTRY[name].run(spark, sf_dir)
    assert len(plans) == 1 and "Join" not in plans[0] and "fulfilment-plain" in plans[0]
