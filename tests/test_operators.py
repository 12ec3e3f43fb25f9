import datetime as dt
import random
import re
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratamart.operators import (catalog, constraints, inventory, lineage, pii, policy, predicates, profile, skew,
                                  token_search, usage)
from stratamart.operators.dedup import latest_per_key
from stratamart.operators.pipeline_lineage import column_edges, table_edges
from stratamart.operators.specs import TableSpec
from stratamart.session import fresh_path
from stratamart.sources.tables import read_partitioned


# --- skew -----------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def hot(spark):
    """A third of the right rows share one key; some left keys have no right rows and some are NULL."""
    rng = random.Random(3)
    right = [("hot" if i % 3 == 0 else f"k{rng.randrange(40)}", i) for i in range(900)] + [(None, -1)]
    left = [(k, i) for i, k in enumerate(["hot", "hot", None, "alone"] + [f"k{j}" for j in range(45)])]
    return (spark.createDataFrame(left, "key string, l int"), spark.createDataFrame(right, "key string, r int"))


def test_join_apart_equals_plain_join(hot):
    left, right = hot
    for a, b in ((left, right), (left, right.where("r < 0")), (left.where("l < 0"), right), (right, left)):
        want = sorted(a.join(b, "key", "left").select("key", "l", "r").collect(), key=str)
        assert sorted(skew.left_join_apart(a, b, "key").select("key", "l", "r").collect(), key=str) == want


def test_join_apart_splits_a_hot_right_key(spark):
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5"}
    left = spark.range(200).selectExpr("concat('k', id) AS key", "id AS l")
    right = spark.range(0, 60000, 1, 6).selectExpr("CASE WHEN id % 3 = 0 THEN 'k1' ELSE concat('k', id % 190) END AS key", "id AS r")
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        df = skew.left_join_apart(left, right, "key")
        assert df.count() == 60010
        df = skew.left_join_apart(left, right, "key")
        df.collect()
        assert "skew=true" in df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_position_in_group(spark):
    rows = [("a" if i % 3 else None, i * 37 % 1001) for i in range(1001)]
    got = skew.position_in_group(spark.createDataFrame(rows, "g string, o long"), "g", "o", ["o"]).collect()
    for g in ("a", None):
        want = sorted(o for k, o in rows if k == g)
        assert [r.o for r in sorted((r for r in got if r.g == g), key=lambda r: r.position)] == want
        assert sorted(r.position for r in got if r.g == g) == list(range(len(want)))


def test_collect_members_has_one_shape(spark):
    df = spark.range(25).select(F.lit("g").alias("g"), (F.col("id") % 5).alias("o"), (F.col("id") * 2).alias("v"))
    got = sorted(skew.collect_members(df.union(spark.sql("SELECT 'h', 1L, 7L")), "g", "o", ["v"]).collect())
    assert [(r.position, r.v) for r in got if r.g == "g"] == list(enumerate(2 * (5 * k + o) for o in range(5) for k in range(5)))
    assert [(r.position, r.v) for r in got if r.g == "h"] == [(0, 7)]


def test_search_keeps_whole_groups(spark):
    rows = [("d", "t1", f"o{i}", "x") for i in range(25)] + [("d", "t1", "Needle", "y"), ("d", "t2", "o1", "z"), ("d", "a_needle", "p", "q")]
    got = catalog.search_options(spark.createDataFrame(rows, "dataset_id string, table_name string, option_name string, option_value string"), "NEEDLE")
    assert sorted(r.table_name for r in got.collect()) == ["a_needle"] + ["t1"] * 26


def test_label_maps_are_replaced_whole(spark):
    rows = [("d", "t", "labels", {"a": "1", "b": "2"}, 1, 1), ("d", "t", "labels", {"b": "3"}, 2, 2), ("d", "u", "labels", None, 1, 3)]
    log = spark.createDataFrame(rows, "dataset_id string, table_name string, option_name string, option_value map<string,string>, at int, seq int")
    assert {r.table_name: r.option_value for r in catalog.current_options(log, "at", "seq").collect()} == {"t": {"b": "3"}, "u": None}


def test_latest_per_key(spark):
    rows = [("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), ("b", None, "n"), ("b", 0, "m"), (None, 1, "p"), (None, 3, "q")]
    got = {(r.k, r.v) for r in latest_per_key(spark.createDataFrame(rows, "k string, t int, v string"), "k", "t").collect()}
    assert got == {("a", "z"), ("b", "m"), (None, "q")}


# --- profiler -------------------------------------------------------------------------------------

SCHEMA = T.StructType([
    T.StructField("n", T.IntegerType()), T.StructField("x", T.DoubleType()), T.StructField("m", T.DecimalType(38, 9)),
    T.StructField("s", T.StringType()), T.StructField("d", T.DateType()), T.StructField("b", T.BooleanType()),
    T.StructField("none", T.StringType()), T.StructField("a", T.ArrayType(T.IntegerType())),
    T.StructField("mp", T.MapType(T.StringType(), T.IntegerType()))])
LONG = "word " * 40
DATA = [
    (1, 0.0, D("1.5"), "a", dt.date(2024, 1, 1), True, None, [1, 2], {"k": 1, "j": 2}),
    (2, -0.0, D("1.5"), LONG + "1", dt.date(2024, 1, 2), False, None, [1, 2], {"j": 2, "k": 1}),
    (2, float("nan"), D("2.5"), LONG + "2", None, True, None, None, None),
    (None, float("nan"), None, LONG + "2", dt.date(2023, 1, 1), None, None, [], {}),
]


@pytest.mark.parametrize("how", ["exact", "approx"])
def test_profile(spark, how):
    df = spark.createDataFrame(DATA, SCHEMA)
    got = {r.column_name: r for r in profile.profile_table(TableSpec("d", "t", df), how).collect()}
    assert [got[c].distinct_count for c in SCHEMA.names] == [2, 2, 2, 3, 3, 2, 0, 2, 2]
    assert [got[c].null_count for c in SCHEMA.names] == [1, 0, 1, 0, 1, 1, 4, 1, 1]
    assert (got["n"].null_pct, got["n"].uniqueness_pct, got["n"].mean, got["n"].stddev) == (25.0, 50.0, 1.6667, 0.5774)
    assert (got["n"].min_number, got["n"].max_number) == (1.0, 2.0)
    assert (got["s"].min_length, got["s"].max_length, got["s"].avg_length) == (1, 201, 151.0)
    assert (got["d"].min_text, got["d"].max_text) == ("2023-01-01", "2024-01-02")
    assert got["none"].null_pct == 100.0 and got["none"].max_length is None
    assert got["b"].min_text is None and got["b"].min_number is None and got["a"].min_length is None
    assert {r.status for r in got.values()} == {"ok"}


def test_profile_of_uncomparable_type_is_an_error_row(spark):
    df = spark.range(2).select("id", F.parse_json(F.lit('{"a": 1}')).alias("v"))
    got = {r.column_name: r for r in profile.profile_table(TableSpec("d", "t", df)).collect()}
    assert got["id"].status == "ok" and got["v"].status.startswith("error") and got["v"].distinct_count is None


def test_profile_reads_a_table_twice_and_shuffles_only_distincts(spark, sf_dir):
    spec = TableSpec("star", "orders", spark.read.parquet(f"{sf_dir}/orders.parquet"))
    plan = profile.profile_table(spec)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 2 and "Expand" not in plan
    plan = profile.profile_table(spec, "approx")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1


def test_quality_summary(spark):
    prof = profile.profile_tables([TableSpec("d", "t", spark.createDataFrame(DATA, SCHEMA)),
                                   TableSpec("d", "v", spark.range(1), kind="VIEW"), TableSpec("d", "e", spark.range(0))])
    rows = profile.quality_rows(prof)
    assert rows.count() == 9
    s = profile.quality_summary(rows).first()
    assert (s.total, s.with_nulls, s.low_distinct, s.high_null) == (9, 7, 0, 1)
    assert predicates.quality_filter(rows, "issues").count() == 7
    assert predicates.quality_filter(rows, "nulls").count() == 7 and predicates.quality_filter(rows).count() == 9


# --- constraints, personal data, policies -----------------------------------------------------------

def test_constraints_on_the_shop(shop):
    pk = constraints.primary_key_check(shop["customers"], "pk", "customer_id").first()
    assert (pk.checked_rows, pk.null_key_rows, pk.violating_keys, pk.violating_rows, pk.sample_key) == (8, 0, 2, 4, "K2")
    fk = constraints.foreign_key_check(shop["orders"], "fk", "customer_id", shop["customers"], "customer_id").first()
    assert (fk.checked_rows, fk.null_key_rows, fk.violating_keys, fk.violating_rows, fk.sample_key) == (12, 1, 1, 1, "GONE")
    assert constraints.foreign_key_orphans(shop["order_items"], "order_id", shop["orders"], "order_id").collect()[0].key == "O9"
    empty = constraints.primary_key_check(shop["customers"].limit(0), "pk", "customer_id").first()
    assert (empty.checked_rows, empty.violating_keys, empty.sample_key) == (0, 0, None)


def test_pii_by_name(spark, shop):
    cols = inventory.column_inventory(spark, [TableSpec("raw", n, df) for n, df in shop.items()])
    found = pii.classify_columns(cols)
    per_table = {r.table_name: r["count"] for r in found.groupBy("table_name").count().collect()}
    assert per_table == {"customers": 7, "orders": 3, "payments": 1}
    by = {r.column_name: (r.pii_classification, r.confidence) for r in found.collect()}
    assert by["address_line1"] == ("Physical Address", "medium") and by["email"] == ("Email Address", "high")
    odd = spark.createDataFrame([("IP_Address",), ("SSN",), ("note",)], "column_name string")
    assert {r.column_name: r.pii_classification for r in pii.classify_columns(odd).collect()} == {
        "IP_Address": "Physical Address", "SSN": "Social Security Number"}
    flagged = pii.flag_columns(cols, found)
    assert flagged.count() == cols.count() and flagged.where("pii").count() == 11
    tables = spark.createDataFrame([("raw", "customers", {}), ("raw", "products", {"pii": "true"}), ("raw", "order_items", None)],
                                   "dataset_id string, table_name string, labels map<string,string>")
    assert {r.table_name: r.pii for r in pii.flag_tables(tables, found).collect()} == {
        "customers": True, "products": True, "order_items": False}


def test_row_policies(spark):
    df = spark.createDataFrame([("VIP",), ("Regular",), (None,)], "seg string")
    vip = policy.RowPolicy("vip", (policy.EVERYONE,), "seg = 'VIP'")
    reg = policy.RowPolicy("reg", ("user:r",), "seg = 'Regular'")
    full = policy.RowPolicy("full", ("svc",), "TRUE")
    count = lambda who, ps: policy.apply_row_policies(df, who, ps).count()
    assert count("user:x", [vip, full]) == 1 and count("svc", [vip, full]) == 3
    assert count("user:r", [vip, reg]) == 2 and count("user:x", [reg]) == 0 and count("user:x", []) == 3


# --- lineage --------------------------------------------------------------------------------------

def test_declared_lineage(spark):
    assert table_edges(spark).count() == 20 and column_edges(spark).count() == 26
    start = spark.createDataFrame([("analytics_ecommerce.customer_360.email",)], "start string")
    got = lineage.trace(column_edges(spark), start).orderBy("position").collect()
    assert [(r.direction, r.transform) for r in got] == [("up", "LOWER()"), ("up", "pass-through")]
    assert got[0].upstream == "raw_ecommerce.customers.email"
    assert lineage.neighbourhood(table_edges(spark), "staging_ecommerce.stg_payments").count() == 3
    assert lineage.node_names(table_edges(spark)).count() == 20


def test_trace_takes_the_first_edge_and_survives_cycles(spark):
    edges = lineage.edges_from(spark, [("a", "b", "1"), ("x", "b", "2"), ("b", "c", "3"), ("b", "d", "4"), ("c", "a", "5")])
    start = spark.createDataFrame([("b",), ("nowhere",)], "start string")
    got = lineage.trace(edges, start).collect()
    assert {r.start for r in got} == {"b"} and len(got) == 6
    path = lambda rows, way: [r.transform for r in sorted((r for r in rows if r.direction == way), key=lambda r: abs(r.position))]
    assert path(got, "down") == ["3", "5", "1"] and path(got, "up") == ["1", "5", "3"]  # until the cycle closes
    assert path(lineage.trace(edges, start, hops=2).collect(), "up") == ["1", "5"]
    every = lineage.trace(edges, start, first_only=False).collect()
    assert sorted(path(every, "down")) == ["1", "3", "4", "5"] and sorted(path(every, "up")) == ["1", "2", "3", "5"]


def test_trace_has_no_hop_bound(spark):
    edges = lineage.edges_from(spark, [(f"n{i}", f"n{i + 1}", str(i)) for i in range(15)])
    got = lineage.trace(edges, spark.createDataFrame([("n0",)], "start string")).collect()
    assert sorted(r.position for r in got) == list(range(1, 16))


def walked(edges, starts, first_only, hops):
    """One hop at a time, in one process."""
    out = []
    for way, here, there in (("up", 1, 0), ("down", 0, 1)):
        for start in starts:
            reached, front, hop = {start}, [start], 0
            while front and (hops is None or hop < hops):
                hop, nxt = hop + 1, []
                for node in front:
                    steps = [(i, e) for i, e in enumerate(edges) if e[here] == node]
                    for _, e in steps[:1] if first_only else steps:
                        out.append((start, way, -hop if way == "up" else hop, *e))
                        if e[there] not in reached:
                            reached.add(e[there])
                            nxt.append(e[there])
                front = nxt
    return sorted(out)


@pytest.mark.parametrize("first_only", [True, False])
@pytest.mark.parametrize("hops", [None, 1, 3, 4])
def test_trace_of_chains_trees_and_cycles(spark, first_only, hops):
    rng = random.Random(8)
    edges = [(f"c{i}", f"c{(i + 1) % 7}", f"cycle{i}") for i in range(7)] + [(f"t{i}", f"c{i % 7}", f"tail{i}") for i in range(3)]
    edges += [(f"d{i}", f"d{i + 1}", "deep") for i in range(9)] + [("s", "s", "self"), ("s", "d0", "out")]
    edges += [(f"r{rng.randrange(12)}", f"r{rng.randrange(12)}", f"random{i}") for i in range(14)]
    rng.shuffle(edges)
    starts = ["c0", "t1", "d0", "d4", "s", "r1", "r2", "r3", "nowhere"]
    got = lineage.trace(lineage.edges_from(spark, edges), spark.createDataFrame([(s,) for s in starts], "start string"), first_only, hops)
    assert sorted(tuple(r) for r in got.collect()) == walked(edges, starts, first_only, hops)


def test_trace_takes_few_rounds(spark, monkeypatch):
    edges = lineage.edges_from(spark, [(f"n{i}", f"n{i + 1}", str(i)) for i in range(100)])
    written, real = [], lineage._counted
    monkeypatch.setattr(lineage, "_counted", lambda df, name: (written.append(name), real(df, name))[1])
    assert lineage.trace(edges, spark.createDataFrame([("n0",)], "start string")).count() == 100
    assert written.count("walk") <= 9


# --- query log ------------------------------------------------------------------------------------

LOG = ("job_id string, user_email string, job_type string, state string, creation_time timestamp, end_time timestamp, "
       "bytes_processed long, bytes_billed long, cache_hit boolean, statement_type string, query string, "
       "referenced_tables array<struct<project_id:string,dataset_id:string,table_id:string>>, "
       "destination_table struct<project_id:string,dataset_id:string,table_id:string>")
NOW = dt.datetime(2024, 5, 10, 12)


def log(spark):
    ref = lambda t: ("p", "d", t)
    h = lambda n: NOW - dt.timedelta(hours=n)
    return spark.createDataFrame([
        ("j1", "ann@x.no", "QUERY", "DONE", h(1), h(0), 2048, None, True, "SELECT", "  " + "q" * 600, [ref("a"), ref("b")], ref("c")),
        ("j2", "bob@x.no", "QUERY", "RUNNING", h(2), None, None, 10, False, None, None, [], None),
        ("j3", None, "QUERY", "DONE", h(3), h(3), 0, 0, None, "SELECT", "q", None, ref("c")),
        ("j4", "ann@x.no", "LOAD", "DONE", h(4), h(4), 1, 1, False, "LOAD", "q", [ref("a")], ref("c")),
        ("j5", "ann@x.no", "QUERY", "DONE", h(24 * 7), h(1), 1, 1, False, "SELECT", "q", [ref("a")], ref("c"))], LOG)


def test_job_history(spark):
    jobs = usage.job_history(log(spark), NOW)
    assert [r.job_id for r in jobs.collect()] == ["j1", "j2", "j3"]  # exactly seven days ago is outside
    assert jobs.select(F.max(F.length("query_preview"))).first()[0] == 500
    assert [r.job_id for r in usage.job_history(log(spark), NOW, rows=1).collect()] == ["j1"]
    s = usage.job_summary(jobs).first()
    assert s.asDict() == dict(total=3, unique_users=2, successful=2, cached=1, cache_rate=33.0, total_bytes=2048, total_billed=10)
    none = usage.job_summary(jobs.limit(0)).first()
    assert none.total == 0 and none.cache_rate == 0 and none.total_bytes == 0
    rows = {r.job_id: r for r in usage.job_list(jobs).collect()}
    assert (rows["j1"].user, rows["j1"].processed, rows["j1"].billed, rows["j1"].duration, rows["j1"].tables) == ("ann", "2 KB", "0 B", "60.0m", 2)
    assert (rows["j2"].statement, rows["j2"].duration, rows["j2"].preview, rows["j2"].cached) == ("QUERY", "-", "-", "-")
    assert rows["j3"].user == "-" and len(rows["j1"].preview) == 83
    edges = usage.usage_edges(log(spark)).collect()
    assert {(e.upstream, e.downstream, e.jobs) for e in edges} == {("d.a", "d.c", 3), ("d.b", "d.c", 1)}


# --- search, catalog, guarded reads -----------------------------------------------------------------

def test_token_search(spark):
    df = spark.createDataFrame([(1, "Blå-grå fox, fox!", "x"), (2, "fox_trot", "blå"), (3, None, "")], "id int, a string, b string")
    toks = token_search.tokens(df, "id")
    assert {(r.token, r.id) for r in toks.collect()} == {("blå", 1), ("grå", 1), ("fox", 1), ("x", 1), ("fox", 2), ("trot", 2), ("blå", 2)}
    assert {r.id for r in token_search.search_tokens(toks, "id", "FOX blå").collect()} == {1, 2}
    assert {r.id for r in token_search.search_tokens(toks, "id", "fox trot").collect()} == {2}


def test_search_and_sort(spark):
    df = spark.createDataFrame([("Bb", 1), ("a", 2), (None, 3)], "n string, v int")
    assert [r.n for r in predicates.sorted_by(df, "n").collect()] == [None, "a", "Bb"]
    assert [r.v for r in predicates.sorted_by(df, "v", "desc").collect()] == [3, 2, 1]
    assert predicates.search(df, "B", "n").count() == 1 and predicates.search(df, "", "n").count() == 3


def test_options_last_writer_wins(spark):
    log_ = spark.createDataFrame([("d", "t", "labels", "old", 1, 1), ("d", "t", "labels", "new", 2, 2), ("d", "t", "x", "1", 1, 3)],
                                 "dataset_id string, table_name string, option_name string, option_value string, at int, seq int")
    got = {r.option_name: r.option_value for r in catalog.current_options(log_, "at", "seq").collect()}
    assert got == {"labels": "new", "x": "1"}


def test_field_paths_and_inventory(spark, sf_dir):
    df = spark.createDataFrame([((1, [("x",), (None,)]),), ((None, []),), (None,)],
                               "s struct<a:int,l:array<struct<v:string>>>")
    got = {r.field_path: r.present_rows for r in inventory.field_paths(TableSpec("d", "t", df)).collect()}
    assert got == {"s": 2, "s.a": 1, "s.l": 2, "s.l.v": 1}
    orders = TableSpec("d", "orders", spark.read.parquet(f"{sf_dir}/orders.parquet"), partition_column="o_orderdate",
                       cluster_columns=("o_custkey",), labels={"pii": "false"})
    row = inventory.table_inventory([orders, TableSpec("d", "v", df, kind="VIEW"), TableSpec("d", "m", df)]).collect()
    assert row[0].num_rows == 1500 and row[0].num_bytes > 10000 and row[0].labels == {"pii": "false"}
    assert row[1].table_type == "VIEW" and row[1].num_rows == 0 and row[2].num_rows == 3
    cols = {r.column_name: r for r in inventory.column_inventory(spark, [orders]).collect()}
    assert cols["o_orderdate"].is_partitioning_column == "YES" and cols["o_custkey"].clustering_ordinal_position == 1


@pytest.mark.parametrize("where", [None, "", "total > 3", "my_day_2 = 3", "'day' = 'day'", "id > 3 OR day IS NOT NULL",
                                   "id > 3 /* day */", "day IS NOT NULL", "day = day"])
def test_guarded_read_refuses(spark, where):
    path = fresh_path(spark, "guarded")
    spark.sql("SELECT id AS total, 1L AS my_day_2, DATE'2024-01-01' AS day, id FROM range(9)").write.partitionBy("day").parquet(path)
    with pytest.raises(ValueError):
        read_partitioned(spark, path, "day", where)
    assert read_partitioned(spark, path, "day", "day >= '2024-01-01' AND total > 3").count() == 5


# --- profiler passes --------------------------------------------------------------------------------

def test_profile_reads_text_and_times_once(spark, tmp_path):
    """Text, dates and flags are read by the pass over values alone, and counts need no lengths or moments."""
    spark.createDataFrame(DATA, SCHEMA).select("n", "s", "d", "b").write.parquet(f"{tmp_path}/t")
    spec = TableSpec("d", "t", spark.read.parquet(f"{tmp_path}/t"))
    reads = lambda df: sorted(re.findall(r"ReadSchema: struct<(.*?)>", df._jdf.queryExecution().executedPlan().toString()))
    assert reads(profile.profile_table(spec)) == ["n:int", "n:int,s:string,d:date,b:boolean"]
    assert reads(profile.profile_table(spec, figures=False)) == ["", "n:int,s:string,d:date,b:boolean"]
    counts = ["column_name", "total_rows", "null_count", "null_pct", "distinct_count", "uniqueness_pct", "status"]
    whole, short = profile.profile_table(spec), profile.profile_table(spec, figures=False)
    assert sorted(whole.select(*counts).collect()) == sorted(short.select(*counts).collect())


def test_profile_of_values_at_the_digest_border(spark):
    import hashlib
    long = "x" * 65
    like = f"{hashlib.sha256(long.encode()).hexdigest()}:65"
    df = spark.createDataFrame([("x" * 64,), (long,), (like,), ("",), ("a:b",), (None,)], "s string")
    r = profile.profile_table(TableSpec("d", "t", df)).first()
    assert (r.distinct_count, r.null_count, r.min_length, r.max_length, r.avg_length) == (5, 1, 0, 67, 39.8)


def test_closure_does_not_walk_into_dead_ends(spark, monkeypatch):
    rows = [(f"p{i}", "s", "t") for i in range(50)] + [("s", "n", "t"), ("s", "n", "t"), ("n", "s", "back"), (None, "s", "t")]
    edges = lineage.edges_from(spark, rows)
    walked = []
    whole = lineage._spread
    monkeypatch.setattr(lineage, "_spread", lambda starts, steps, hops: walked.append(steps.count()) or whole(starts, steps, hops))
    starts = spark.createDataFrame([("n",), ("p0",)], "start string")
    got = lineage.trace(edges, starts, first_only=False)
    assert walked == [2 * 3 + 50]  # both ways along s and n, and down from each p, but never up into one
    by = {(r.start, r.direction, r.position): r["count"] for r in got.groupBy("start", "direction", "position").count().collect()}
    assert by == {("n", "up", -1): 2, ("n", "up", -2): 52, ("n", "down", 1): 1, ("n", "down", 2): 2,
                  ("p0", "down", 1): 1, ("p0", "down", 2): 2, ("p0", "down", 3): 1}
