"""Streaming append and statistics of landed rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.casts import utc_instant
from ..operators.inventory import files_of


def read_arrivals(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "json",
                  files_per_batch: int | None = None, glob: str | None = None) -> DataFrame:
    """New files of a folder as a stream, with a fixed schema."""
    r = spark.readStream.schema(schema)
    if files_per_batch:
        r = r.option("maxFilesPerTrigger", files_per_batch)
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.format(fmt).load(path)


def append_stream(stream: DataFrame, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Append arrivals to a table. The checkpoint makes each file count exactly once.

    Without ``every`` the stream takes what is there and ends, for an outside scheduler.
    """
    w = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    w = w.trigger(processingTime=every) if every else w.trigger(availableNow=True)
    return w.start(path)


def buffer_stats(landed: DataFrame, arrived_at: str, since=None) -> DataFrame:
    """Rows, bytes and oldest entry of landed rows, all or those after ``since``.

    Bytes are whole files that hold at least one of the rows.
    """
    fresh = landed if since is None else landed.where(F.col(arrived_at) > utc_instant(since))
    per_file = files_of(fresh, also=(F.min(arrived_at).alias("oldest"),))
    return per_file.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("estimated_rows"),
        F.coalesce(F.sum("file_size"), F.lit(0)).alias("estimated_bytes"),
        F.min("oldest").alias("oldest_entry_time"))
