"""Streams with state, their live figures, and the landing they leave behind.

Events arrive in slices, one file and micro-batch each, in an order that a column of the
event decides, so the check SQL sees the same arrivals.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import fresh_path
from ..sources.retail import table
from ..streaming import append, landing, progress, unique, windows
from .registry import query

C = F.col


def arrive(df: DataFrame, number: Column, slices: range, path: str) -> str:
    """Write the rows of each slice as one further file of an arrivals folder."""
    for k in slices:
        df.where(number == k).coalesce(1).write.mode("append").parquet(path)
    return path


def arriving(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    return append.read_arrivals(spark, path, like.schema, "parquet", files_per_batch=1)


# --- event-time revenue ---------------------------------------------------------------------------
# Five days of events make a slice; every tenth event comes a slice late and every 25th two slices.
# A batch closes windows by the latest time of the batches before it, so its own late rows are those
# of windows the batch before had closed; the end of a run closes them by all that came.

_SLICES = 8
_RESTART = 3
_LATE_DAYS = 2


def _slice_of(ts: Column, event_id: Column) -> Column:
    base = F.floor(F.date_diff(F.to_date(ts), F.lit("2024-01-01").cast("date")) / 5)
    behind = F.when(event_id % 25 == 7, 2).when(event_id % 10 == 3, 1).otherwise(0)
    return F.least(F.lit(_SLICES - 1), F.greatest(F.lit(0), base) + behind).cast("int")


def _cents(value: Column) -> Column:
    return F.round(value * 100).cast("long")


def _event_time_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    arrivals, closed, state = (fresh_path(spark, n) for n in ("events-late", "windows-closed", "windows-checkpoint"))
    for part in (range(_RESTART), range(_RESTART, _SLICES)):  # stopped, then started again from its checkpoint
        arrive(events, _slice_of(C("ts"), C("event_id")), part, arrivals)
        found = windows.windowed_revenue(arriving(spark, arrivals, events), "ts", _cents(C("value")), "1 day", f"{_LATE_DAYS} days")
        windows.append_windows(found, closed, state).awaitTermination()
    done, waiting = spark.read.schema(found.schema).parquet(closed), windows.open_windows(spark, state)
    late = windows.late_rows(events, "ts", done, waiting).select(
        F.lit("late").alias("state"), F.lit(None).cast("timestamp").alias("window_start"), C("late").alias("n_rows"),
        F.lit(None).cast("long").alias("revenue"))
    rows = late
    for name, df in (("closed", done), ("open", waiting)):
        rows = rows.unionByName(df.select(F.lit(name).alias("state"), "window_start", "n_rows", "revenue"))
    return rows


query("T3_event_time_revenue", f"""
WITH arrived AS (SELECT CAST(ts AS DATE) AS day, ts, CAST(round(value * 100) AS BIGINT) AS cents,
 least({_SLICES - 1}, greatest(0, date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) // 5)
  + CASE WHEN event_id % 25 = 7 THEN 2 WHEN event_id % 10 = 3 THEN 1 ELSE 0 END) AS slice FROM events),
ends AS (SELECT slice, max(ts) AS last FROM arrived GROUP BY 1),
marks AS (SELECT slice, CASE slice WHEN {_RESTART} THEN max(last) OVER (ORDER BY slice ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
  ELSE max(last) OVER (ORDER BY slice ROWS BETWEEN UNBOUNDED PRECEDING AND 2 PRECEDING) END - INTERVAL {_LATE_DAYS} DAY AS mark FROM ends),
judged AS (SELECT a.*, coalesce(a.day + INTERVAL 1 DAY <= m.mark, false) AS late FROM arrived a JOIN marks m USING (slice)),
final AS (SELECT max(ts) - INTERVAL {_LATE_DAYS} DAY AS mark FROM arrived)
SELECT 'late' AS state, CAST(NULL AS TIMESTAMP) AS window_start, count(*) FILTER (late) AS n_rows, CAST(NULL AS BIGINT) AS revenue FROM judged
UNION ALL SELECT CASE WHEN day + INTERVAL 1 DAY <= (SELECT mark FROM final) THEN 'closed' ELSE 'open' END, CAST(day AS TIMESTAMP),
 count(*), CAST(sum(cents) AS BIGINT) FROM judged WHERE NOT late GROUP BY day""")(_event_time_revenue)


# --- streaming deduplication ----------------------------------------------------------------------
# Four slices of events; with each but the first, the one before is sent once more.

def _sent(events: DataFrame) -> DataFrame:
    number = F.least(F.lit(3), F.floor((F.dayofmonth("ts") - 1) / 8)).cast("int")
    first = events.withColumn("slice", number)
    again = first.where("slice < 3").withColumn("slice", C("slice") + 1)
    return first.unionByName(again)


@query("T1_stream_unique", "SELECT * FROM events")
def stream_unique(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    sent = _sent(events)
    arrivals, path, state = (fresh_path(spark, n) for n in ("events-sent", "events-unique", "unique-checkpoint"))
    for part in (range(2), range(2, 4)):  # started again from its checkpoint, with repeats of what came before
        arrive(sent, C("slice"), part, arrivals)
        stream = arriving(spark, arrivals, sent).drop("slice")
        unique.append_unique(stream, path, state, "ts", "event_id", remember="20 days").awaitTermination()
    return spark.read.schema(events.schema).parquet(path)


# --- live figures ---------------------------------------------------------------------------------

@query("T2_live_figures", """
SELECT CAST(least(4, event_id % 7) AS BIGINT) AS batch_id, count(*) AS input_rows, count(*) AS landed_rows FROM events GROUP BY 1""")
def live_figures(spark, sf_dir):
    """Rows reported for each batch beside the rows of the file that batch took."""
    events = table(spark, sf_dir, "events").withColumn("part", F.least(F.lit(4), C("event_id") % 7).cast("int"))
    arrivals, path, state, told = (fresh_path(spark, n) for n in ("events-watched", "watched", "watched-checkpoint", "progress"))
    arrive(events, C("part"), range(5), arrivals)
    with progress.ProgressTable(spark, told, every=2) as watch:
        append.append_stream(arriving(spark, arrivals, events), path, state).awaitTermination()
    landed = spark.read.schema(events.schema).parquet(path).groupBy(C("part").cast("long").alias("batch_id")).agg(F.count("*").alias("landed_rows"))
    return progress.batch_figures(watch.read()).select("batch_id", "input_rows").join(landed, "batch_id", "full")


# --- landing --------------------------------------------------------------------------------------

@query("T3_compacted_landing", "SELECT *, strftime(ts, '%Y-%m-%d') AS day FROM events")
def compacted_landing(spark, sf_dir):
    """Seven batches land by day and are merged three at a time; one is replayed after it was merged."""
    events = table(spark, sf_dir, "events").withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    path = fresh_path(spark, "events-landing")
    for b in [0, 1, 2, 3, 4, 2, 5, 6]:
        landing.land_batch(events.where(C("event_id") % 7 == b), b, path, "day")
        landing.compact(events, path, "day", fan=3)
    return landing.landed(events, path).drop("batch")
