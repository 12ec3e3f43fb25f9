"""Event-time windows over a stream: revenue per tumbling window, late rows counted.

State holds one row per open window, never the rows. A window is written once, when the
watermark (the latest event time seen, less ``late``) has passed its end; rows of a
window that was closed before they came are left out of it and counted by ``late_rows``.
Windows still open are read from the state store, so nothing that arrived is unaccounted for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def windowed_revenue(events: DataFrame, time: str, amount: Column, size: str = "1 day", late: str = "2 days") -> DataFrame:
    """Per window of ``size``: rows and amount. The same for a stream and, without the late rule, for a table.

    Rows without an event time belong to no window.
    """
    timed = events.select(F.col(time).cast("timestamp").alias("event_time"), amount.alias("amount"))
    if events.isStreaming:
        timed = timed.withWatermark("event_time", late)
    return timed.groupBy(F.window("event_time", size)).agg(
        F.count("*").alias("n_rows"), F.sum("amount").alias("revenue")).select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "n_rows", "revenue")


def append_windows(windows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write each window once, when it closes. Takes what has arrived and ends; the state waits in the checkpoint."""
    return (windows.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start(path))


def open_windows(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Windows the state holds and the watermark has not passed, in the shape of the written ones."""
    state = spark.read.format("statestore").load(checkpoint)
    start = state.schema["key"].dataType.names[0]  # the grouping window
    count, revenue = state.schema["value"].dataType.names[-2:]  # the buffers of the two aggregates, in order
    window = F.col("key")[start]
    return state.select(window["start"].alias("window_start"), window["end"].alias("window_end"),
                        F.col("value")[count].alias("n_rows"), F.col("value")[revenue].alias("revenue"))


def late_rows(arrived: DataFrame, time: str, closed: DataFrame, still_open: DataFrame) -> DataFrame:
    """One row: rows that arrived with an event time, rows in closed and in open windows, and the rest, which came late."""
    counted = arrived.where(F.col(time).isNotNull()).agg(F.count("*").alias("arrived"))
    inside = lambda df, name: df.agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias(name))
    parts = [counted, inside(closed, "in_closed"), inside(still_open, "in_open")]
    stacked = parts[0]
    for p in parts[1:]:
        stacked = stacked.unionByName(p, allowMissingColumns=True)
    one = stacked.agg(*[F.max(c).alias(c) for c in ("arrived", "in_closed", "in_open")])
    return one.withColumn("late", F.col("arrived") - F.col("in_closed") - F.col("in_open"))
