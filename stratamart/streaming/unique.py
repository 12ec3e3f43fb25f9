"""Streaming deduplication with bounded state: a key is remembered for a while of event time, not for ever."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def without_repeats(stream: DataFrame, time: str, *keys: str, remember: str = "7 days") -> DataFrame:
    """The first row of each key; repeats within ``remember`` of its event time are dropped.

    State holds one entry per key whose event time is within ``remember`` of the latest
    seen, whatever the length of the stream. A repeat that comes later than that is older
    than the watermark, as its event time is the same, and is dropped for that.
    """
    timed = stream.withColumn("_event_time", F.col(time).cast("timestamp")).withWatermark("_event_time", remember)
    return timed.dropDuplicatesWithinWatermark(list(keys)).drop("_event_time")


def append_unique(stream: DataFrame, path: str, checkpoint: str, time: str, *keys: str, remember: str = "7 days") -> StreamingQuery:
    """Append first rows to a table; the checkpoint carries the remembered keys over a restart."""
    return (without_repeats(stream, time, *keys, remember=remember).writeStream.format("parquet").outputMode("append")
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start(path))
