"""Live figures of running streams as a table: one row per query run and micro-batch.

A listener keeps the rows of a few batches and appends them to a parquet table, so the
driver never holds more than ``every`` of them, however long a stream runs. A stream
restarted from its checkpoint has a new run id; a batch that is run again is a row again, and
``batch_figures`` takes the last.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from ..operators.dedup import latest_per_key

PROGRESS = ("query_id string, run_id string, name string, batch_id long, started_at string, input_rows long, output_rows long, "
            "input_rows_per_second double, processed_rows_per_second double, batch_ms long, watermark string, "
            "state_rows long, state_rows_dropped long, state_bytes long")


def progress_row(p) -> tuple:
    """The figures of one progress report."""
    state = p.stateOperators
    return (str(p.id), str(p.runId), p.name, p.batchId, p.timestamp, p.numInputRows,
            p.sink.numOutputRows if p.sink else None, p.inputRowsPerSecond, p.processedRowsPerSecond,
            p.durationMs.get("triggerExecution"), (p.eventTime or {}).get("watermark"),
            sum(s.numRowsTotal for s in state), sum(s.numRowsDroppedByWatermark for s in state),
            sum(s.memoryUsedBytes for s in state))


class ProgressTable(StreamingQueryListener):
    """Appends the progress of the session's streams to ``path``; ``close`` writes what is left."""

    def __init__(self, spark: SparkSession, path: str, every: int = 100):
        self.spark, self.path, self.every = spark, path, every
        self.rows: list[tuple] = []
        self.running: set[str] = set()
        self.lock, self.ended = threading.RLock(), threading.Condition()

    def onQueryStarted(self, event) -> None:
        with self.ended:
            self.running.add(str(event.runId))

    def onQueryProgress(self, event) -> None:
        with self.lock:
            self.rows.append(progress_row(event.progress))
            if len(self.rows) >= self.every:
                self._flush()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self.ended:
            self.running.discard(str(event.runId))
            self.ended.notify_all()

    def _flush(self) -> None:
        if self.rows:
            self.spark.createDataFrame(self.rows, PROGRESS).coalesce(1).write.mode("append").parquet(self.path)
            self.rows = []

    def __enter__(self):
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *exc) -> None:
        """Reports come after the batch; wait until those of all ended streams are here."""
        with self.ended:
            self.ended.wait_for(lambda: not self.running, timeout=60)
        self.spark.streams.removeListener(self)
        with self.lock:
            self._flush()

    def read(self) -> DataFrame:
        return self.spark.read.schema(PROGRESS).parquet(self.path)


def batch_figures(progress: DataFrame) -> DataFrame:
    """The last report of every batch of a query, whichever run it came from."""
    return latest_per_key(progress, ["query_id", "batch_id"], "started_at")


def live_figures(progress: DataFrame) -> DataFrame:
    """Per query: batches, rows in and out, rows per second while busy, rows dropped as late, state at the last report."""
    last = F.max_by(F.struct("state_rows", "state_bytes", "watermark"), "batch_id")
    return batch_figures(progress).groupBy("query_id").agg(
        F.count("*").alias("batches"), F.sum("input_rows").alias("input_rows"),
        F.sum("state_rows_dropped").alias("dropped_by_watermark"),
        F.round(F.sum("input_rows") * 1000.0 / F.sum("batch_ms"), 1).alias("rows_per_second"), last.alias("last")).select(
        "query_id", "batches", "input_rows", "rows_per_second", "dropped_by_watermark", "last.*")
