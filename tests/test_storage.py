"""Writers, stored summaries, documents and streams."""

import datetime as dt
import json
from decimal import Decimal as D
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from stratamart import session
from stratamart.operators import catalog
from stratamart.plans import analytics, pipeline, upkeep
from stratamart.plans.staging import STAGING
from stratamart.sources import metadata_docs, sinks, tables
from stratamart.streaming import append, refresh
from stratamart.types import RAW_SCHEMAS, SECTION_SCHEMAS


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def stored(df):
    return sorted(map(str, df.collect()))


def test_work_dir_is_the_named_one(spark):
    root = session.work_dir(spark)
    assert spark.conf.get("spark.checkpoint.dir") == root == session.work_dir(spark)
    assert session.fresh_path(spark, "x") != session.fresh_path(spark, "x")


def test_partition_pruning(spark, shop, scratch):
    path = upkeep.store_staged_orders(STAGING["orders"](shop["orders"]), scratch("orders"))
    df = tables.read_partitioned(spark, path, "order_date", "order_date >= DATE'2024-04-01'")
    assert df.count() == 5 and "PartitionFilters: [isnotnull(order_date" in plan_of(df)
    assert spark.read.parquet(path).count() == shop["orders"].count()  # undated rows are kept too


def test_clustered_write_spreads_a_hot_value(spark, scratch):
    df = spark.range(20000).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("s"), F.col("id") % 50)).alias("k"), "id")
    path = sinks.write_clustered(df, scratch("clustered"), "k", files=12)
    back = spark.read.parquet(path)
    assert back.count() == 20000
    files = back.where("k = 'hot'").select("_metadata.file_path").distinct().count()
    assert 3 <= files <= 6
    with pytest.raises(ValueError):
        sinks.clustered(df, "a", "b", "c", "d", "e")


def test_bucketed_join_has_no_shuffle(spark, scratch):
    for t in ("bucketed_a", "bucketed_b"):
        sinks.write_bucketed(spark.range(100).withColumnRenamed("id", "k"), t, scratch(t), "k", 4)
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        plan = plan_of(spark.table("bucketed_a").join(spark.table("bucketed_b"), "k"))
        assert "SortMergeJoin" in plan and "Exchange" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for t in ("bucketed_a", "bucketed_b"):
            spark.sql(f"DROP TABLE {t}")


def test_layers_stored_and_loaded(spark, shop, scratch):
    paths = pipeline.store_layer(pipeline.stage_all(shop), scratch("staging"), {"payments": "currency"})
    stg = pipeline.load_layer(spark, paths)
    assert stg["payments"].count() == 6
    as_of = dt.date(2024, 6, 1)
    from_store = analytics.customer_360(stg["customers"], stg["orders"], as_of)
    direct = analytics.customer_360(STAGING["customers"](shop["customers"]), STAGING["orders"](shop["orders"]), as_of)
    assert stored(from_store) == stored(direct)


def test_retention_drops_old_days_only(spark, scratch):
    days = spark.sql("SELECT explode(sequence(DATE'2024-01-01', DATE'2024-04-09')) AS day, 1 AS v")
    path = sinks.write_partitioned(days, scratch("days"), "day")
    dropped = sinks.drop_expired_partitions(spark, path, "day", dt.date(2024, 4, 10), 90)
    assert dropped == [f"2024-01-{d:02d}" for d in range(1, 11)]
    assert spark.read.parquet(path).agg(F.min("day")).first()[0] == dt.date(2024, 1, 11)


def test_snapshots(spark, scratch):
    root = scratch("snapshots")
    upkeep.snapshot_table(spark.range(3), "t", root, dt.datetime(2024, 1, 1))
    upkeep.snapshot_table(spark.range(5), "t", root, dt.datetime(2024, 2, 1))
    at = lambda m: upkeep.read_snapshot(spark, f"{root}/snapshot_registry", "t", dt.datetime(2024, m, 15)).count()
    assert (at(1), at(2)) == (3, 5)
    for hour, rows in ((8, 7), (20, 9), (20, 9)):  # two on one day, the second taken twice
        upkeep.snapshot_table(spark.range(rows), "t", root, dt.datetime(2024, 3, 1, hour))
    on_day = lambda h: upkeep.read_snapshot(spark, f"{root}/snapshot_registry", "t", dt.datetime(2024, 3, 1, h)).count()
    assert (on_day(12), on_day(23)) == (7, 9) and spark.read.parquet(f"{root}/snapshot_registry").count() == 4
    with pytest.raises(LookupError):
        upkeep.read_snapshot(spark, f"{root}/snapshot_registry", "t", dt.datetime(2023, 1, 1))


def test_summary_refresh_with_late_and_vanishing_orders(spark, shop, scratch):
    orders = STAGING["orders"](shop["orders"])
    path = scratch("summary")
    upkeep.build_daily_summary(orders, path)
    # March loses every revenue order, April gains a late one, the undated month is not touched.
    april = orders.where("order_date >= '2024-04-01'").union(
        orders.where("order_id = 'V1'").withColumn("order_id", F.lit("V9")))
    now = april.union(orders.where("order_date is null"))
    touched = orders.where("order_date is not null")
    for _ in range(2):  # repeating changes nothing
        upkeep.refresh_daily_summary(now, touched, path)
        got = upkeep.read_daily_summary(spark, path)
        assert stored(got) == stored(upkeep.daily_summary(analytics.revenue_daily(now)))
        assert got.where("order_date = '2024-04-01'").first().total_revenue == D("20.02")


def write_json(folder: Path, name: str, rows) -> None:
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps(r) for r in rows))


def test_stream_append_and_restart(spark, tmp_path):
    new = tmp_path / "payments"
    row = lambda i: {"payment_id": f"S{i}", "order_id": "O2", "amount": "1.00", "_ingested_at": f"2024-03-0{i}T00:00:00"}
    sink, state = str(tmp_path / "sink"), str(tmp_path / "state")

    def run():
        stream = append.read_arrivals(spark, str(new), RAW_SCHEMAS["payments"])
        append.append_stream(stream, sink, state).awaitTermination()
        return spark.read.parquet(sink)
    write_json(new, "1.json", [row(2), row(3)])
    assert run().count() == 2
    write_json(new, "2.json", [row(1)])
    landed = run()
    assert landed.count() == 3 and run().count() == 3  # nothing is taken twice
    stats = append.buffer_stats(landed, "_ingested_at").first()
    assert stats.estimated_rows == 3 and stats.estimated_bytes > 0 and stats.oldest_entry_time == dt.datetime(2024, 3, 1)
    since = append.buffer_stats(landed, "_ingested_at", dt.datetime(2024, 3, 2)).first()
    assert since.estimated_rows == 1


def test_streamed_payment_fans_out_fulfilment(spark, shop):
    extra = spark.createDataFrame([("S1", "O2", "credit_card", "success", "150.98", "NOK", "2024-03-09T00:00:00", "g", "9999", "pay",
                                    dt.datetime(2024, 3, 9))], RAW_SCHEMAS["payments"])
    build = lambda p: analytics.order_fulfillment(
        STAGING["orders"](shop["orders"]), STAGING["payments"](p), STAGING["shipping_events"](shop["shipping_events"]))
    assert build(shop["payments"]).where("order_id = 'O2'").count() == 1
    assert build(shop["payments"].union(extra)).where("order_id = 'O2'").count() == 2


def test_stream_refresh_replays_safely(spark, shop, scratch):
    landing, summary = scratch("landing"), scratch("summary")
    staged = STAGING["orders"](shop["orders"])
    first, second = staged.where("order_id < 'O4'"), staged.where("order_id >= 'O4'")
    for batch_id, batch in [(0, first), (1, second), (1, second)]:  # the last batch is replayed
        dated = upkeep.with_month(batch)
        new = refresh.land_batch(dated, batch_id, landing)
        upkeep.refresh_daily_summary(refresh.landed(dated, landing), new, summary)
    assert stored(upkeep.read_daily_summary(spark, summary)) == stored(upkeep.daily_summary(analytics.revenue_daily(staged)))


def test_refresh_reads_touched_months_only(spark, shop, scratch, monkeypatch):
    landing, plans = scratch("landing"), []
    staged = upkeep.with_month(STAGING["orders"](shop["orders"]))
    refresh.land_batch(staged, 0, landing)
    new = refresh.land_batch(staged.where("order_month = '2024-03'"), 1, landing)
    write = upkeep.write_partitioned
    monkeypatch.setattr(upkeep, "write_partitioned", lambda df, *a, **k: (
        plans.append(df._jdf.queryExecution().executedPlan().toString()), write(df, *a, **k))[1])
    upkeep.refresh_daily_summary(refresh.landed(staged, landing), new, scratch("summary"))
    assert "2024-03" in plans[0].split("PartitionFilters: [")[1].split("]")[0]


def test_broken_documents_are_counted(spark, tmp_path):
    (tmp_path / "good.json").write_text(json.dumps({"datasets": [{"dataset_id": "raw"}]}))
    (tmp_path / "bad.json").write_text('{"datasets": [{"dataset_id": ')
    docs = metadata_docs.read_documents(spark, str(tmp_path))
    row = metadata_docs.broken_documents(docs).first()
    assert (row.documents, row.broken) == (2, 1)
    with pytest.raises(Exception, match="(?i)malformed|FAILFAST"):
        (tmp_path / "rows").mkdir()
        (tmp_path / "rows" / "a.json").write_text('{"payment_id": "p1"\n')
        tables.read_raw(spark, "payments", str(tmp_path / "rows"), "json").collect()


def test_metadata_dump(spark, tmp_path):
    doc = {
        "extraction_metadata": {"project_id": "p", "datasets_scanned": ["raw"]},
        "datasets": [{"dataset_id": "raw", "labels": {"owner": "x"}, "access_entries": [
            {"role": "READER", "entity_type": "userByEmail", "entity_id": "a@x.no"},
            {"role": None, "entity_type": "view", "entity_id": "v1"}]}],
        "tables": [{"dataset_id": "raw", "table_name": "t", "table_type": "TABLE", "num_rows": 3, "labels": {"pii": "true"},
                    "clustering_fields": ["a"], "partitioning": {"type": "DAY", "field": "d"},
                    "schema_fields": [{"name": "a", "field_type": "STRING", "fields": []},
                                      {"name": "r", "field_type": "RECORD", "fields": [{"name": "b", "field_type": "INT64"}]}]}],
        "lineage": {"table_lineage": [{"upstream": "a", "downstream": "b", "transform": "x"}], "column_lineage": []},
        "search_indexes": [{"index_name": "i"}], "routines": [],
    }
    for project in ("one", "two"):
        (tmp_path / f"{project}.json").write_text(json.dumps(doc, indent=2))
    docs = metadata_docs.read_documents(spark, str(tmp_path))
    assert docs.count() == 2
    assert {r.field_path for r in metadata_docs.schema_fields(docs).collect()} == {"a", "r", "r.b"}
    assert metadata_docs.section(docs, "lineage.table_lineage").count() == 2
    for name, schema in SECTION_SCHEMAS.items():  # empty sections keep their columns
        assert metadata_docs.section(docs, name).columns == schema.names
    access = catalog.access_rows(metadata_docs.section(docs, "datasets"))
    assert access.count() == 4 and catalog.authorized_views(access).count() == 2
    counts = catalog.section_counts(docs)
    got = {r.section: r.records for r in counts.collect()}
    assert len(got) == 26 and got["tables"] == 2 and got["search_indexes"] == 2 and got["routines"] == 0 and got["jobs"] == 0
    assert catalog.coverage_summary(counts).first().populated == 4
    same = catalog.coverage_of({n: metadata_docs.section(docs, n) for n in ("tables", "datasets")})
    assert {r.section: r.records for r in same.collect()}["tables"] == 2
