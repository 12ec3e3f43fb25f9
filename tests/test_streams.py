"""Streams with state, progress tables and landing segments."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from stratamart.plans import upkeep
from stratamart.queries.streams import arrive, arriving
from stratamart.streaming import append, landing, progress, refresh, unique, windows


@pytest.fixture(scope="module")
def clicks(spark):
    """Three slices: in order, with a late row in the third and a row without time."""
    at = lambda day, hour=1: dt.datetime(2024, 1, day, hour)
    rows = [(0, 1, at(1), 10), (0, 2, at(1, 5), 20), (0, 3, at(2), 30), (1, 4, at(6), 40), (1, 5, None, 50),
            (2, 6, at(6, 2), 60), (3, 7, at(1, 9), 70), (3, 8, at(7), 80)]
    return spark.createDataFrame(rows, "slice int, id long, ts timestamp, v long")


def test_windows_close_once_and_late_rows_are_counted(spark, clicks, scratch):
    arrivals, path, state = scratch("arrivals"), scratch("windows"), scratch("state")
    found = None
    for part in (range(2), range(2, 4)):  # started again from the checkpoint
        arrive(clicks, F.col("slice"), part, arrivals)
        found = windows.windowed_revenue(arriving(spark, arrivals, clicks), "ts", F.col("v"), "1 day", "2 days")
        windows.append_windows(found, path, state).awaitTermination()
    closed = spark.read.schema(found.schema).parquet(path)
    day = lambda r: r.window_start.day
    assert {day(r): (r.n_rows, r.revenue) for r in closed.collect()} == {1: (2, 30), 2: (1, 30)} and closed.count() == 2
    still = windows.open_windows(spark, state)
    assert {day(r): (r.n_rows, r.revenue) for r in still.collect()} == {6: (2, 100), 7: (1, 80)}
    row = windows.late_rows(clicks, "ts", closed, still).first()
    assert (row.arrived, row.in_closed, row.in_open, row.late) == (7, 3, 3, 1)
    whole = windows.windowed_revenue(clicks, "ts", F.col("v"))
    assert {day(r): r.n_rows for r in whole.collect()} == {1: 3, 2: 1, 6: 2, 7: 1}  # a table has no late rows


def test_unique_rows_over_a_restart_with_bounded_state(spark, scratch):
    at = lambda day: dt.datetime(2024, 1, day)
    rows = [(0, "a", at(1)), (0, "b", at(1)), (0, "a", at(1)), (1, "a", at(2)), (1, "c", at(20)), (2, "c", at(20)), (2, "d", at(21))]
    sent = spark.createDataFrame(rows, "slice int, k string, ts timestamp")
    arrivals, path, state, told = scratch("arrivals"), scratch("unique"), scratch("state"), scratch("progress")
    for part in (range(1), range(1, 3)):
        arrive(sent, F.col("slice"), part, arrivals)
        with progress.ProgressTable(spark, told) as watch:
            unique.append_unique(arriving(spark, arrivals, sent), path, state, "ts", "k", remember="3 days").awaitTermination()
    assert sorted(r.k for r in spark.read.schema(sent.schema).parquet(path).collect()) == ["a", "b", "c", "d"]
    last = progress.live_figures(watch.read()).first()
    assert last.state_rows == 2  # only keys within three days of the latest time are remembered


def test_progress_rows_equal_the_landed_rows(spark, clicks, scratch):
    arrivals, path, state, told = (scratch(n) for n in ("arrivals", "landed", "state", "progress"))
    arrive(clicks, F.col("slice"), range(4), arrivals)
    with progress.ProgressTable(spark, told, every=3) as watch:
        append.append_stream(arriving(spark, arrivals, clicks), path, state).awaitTermination()
    got = {r.batch_id: r.input_rows for r in progress.batch_figures(watch.read()).collect()}
    assert got == {r.slice: r["count"] for r in clicks.groupBy("slice").count().collect()}
    figures = progress.live_figures(watch.read()).first()
    assert (figures.batches, figures.input_rows, figures.dropped_by_watermark) == (4, 8, 0) and figures.rows_per_second > 0
    again = watch.read().unionByName(watch.read().withColumn("run_id", F.lit("later")).withColumn("started_at", F.lit("9999")))
    assert progress.batch_figures(again).count() == 4  # a batch run again counts once


@pytest.fixture()
def days(spark):
    return spark.range(1000).select("id", F.concat(F.lit("d"), F.col("id") % 4).alias("day"))


def stored_ids(df):
    return sorted(r.id for r in df.select("id").collect())


def test_landing_is_bounded_after_many_batches(spark, days, scratch):
    path = scratch("landing")
    for b in range(30):
        landing.land_batch(days.where(F.col("id") % 30 == b), b, path, "day")
        live = landing.compact(days, path, "day", fan=3)
        assert len(live) <= 2 * 4  # fewer than three of each of the four levels
    got = landing.landed(days, path)
    assert stored_ids(got) == list(range(1000)) and got.groupBy("batch").count().count() == 30
    folders = len(landing.all_segments(spark, path))
    assert folders <= 2 * 4 + 3 * 4  # superseded ones wait for the next compaction
    plan = got.where("day = 'd1'")._jdf.queryExecution().executedPlan().toString()
    assert "day" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_a_killed_compaction_leaves_a_readable_landing(spark, days, scratch, monkeypatch):
    path = scratch("landing")
    for b in range(4):
        landing.land_batch(days.where(F.col("id") % 4 == b), b, path, "day")
    real = landing._publish

    def killed(*args):
        raise RuntimeError("killed")
    monkeypatch.setattr(landing, "_publish", killed)  # after the merged rows were written, before they are seen
    with pytest.raises(RuntimeError):
        landing.compact(days, path, "day", fan=2)
    assert stored_ids(landing.landed(days, path)) == list(range(1000))
    monkeypatch.setattr(landing, "_publish", real)
    assert landing.compact(days, path, "day", fan=2) == [(0, 3)]  # old segments are still there and count once
    assert stored_ids(landing.landed(days, path)) == list(range(1000))
    assert len(landing.all_segments(spark, path)) > 1
    landing.compact(days, path, "day", fan=2)
    assert landing.all_segments(spark, path) == [(0, 3)]


def test_replays_land_once(spark, days, scratch):
    path = scratch("landing")
    for b in (0, 1, 1, 2, 0):
        new = landing.land_batch(days.where(F.col("id") % 3 == b), b, path, "day")
        assert new.count() in (333, 334) and {r.batch for r in new.select("batch").distinct().collect()} == {b}
        landing.compact(days, path, "day", fan=2)
    assert stored_ids(landing.landed(days, path)) == list(range(1000))
    assert landing.landed(days, scratch("nothing")).count() == 0


def test_superseded_segments():
    assert landing.superseded([(0, 0), (0, 2), (1, 1), (2, 2), (3, 3), (3, 4), (4, 4)]) == [(0, 0), (1, 1), (2, 2), (3, 3), (4, 4)]
    sizes = {(0, 7): 10, (8, 8): 1, (9, 9): 1, (10, 10): 99}
    assert landing._run_to_merge(sorted(sizes), sizes, 2, 50) == [(8, 8), (9, 9)]
    assert landing._run_to_merge([(0, 0), (1, 3)], {(0, 0): 1, (1, 3): 1}, 2, 50) == []


def test_refreshes_merge_the_landing(spark, shop, scratch):
    from stratamart.plans.staging import STAGING
    staged = upkeep.with_month(STAGING["orders"](shop["orders"]))
    path = scratch("landing")
    for b in range(5):
        refresh.land_batch(staged.where(F.pmod(F.xxhash64("order_id"), F.lit(5)) == b), b, path)
        refresh.compact(staged, path, fan=2)
    assert landing.landed(staged, path).count() == staged.count() and len(landing.live_segments(spark, path)) == 2


def test_arrivals_are_written_by_the_source_tasks(spark, scratch):
    """A slice is one batch of as many files as the source has parts; none gathers the slice."""
    from stratamart.queries.writes import _arrive
    path, seen = scratch("arriving"), []
    df = spark.range(0, 4000, 1, 8).select(F.concat(F.lit("o"), "id").alias("order_id"))

    class Done:
        def awaitTermination(self):
            seen.append((spark.read.parquet(path).count(), len(spark.read.parquet(path).inputFiles())))
    _arrive(df, 3, path, Done)
    assert [files for _, files in seen] == [8, 16, 24]
    assert seen[0][0] < seen[1][0] < seen[2][0] == 4000 and spark.read.parquet(path).distinct().count() == 4000
