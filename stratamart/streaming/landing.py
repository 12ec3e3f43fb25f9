"""Landed micro-batches in segments, merged as they grow in number.

A landing folder holds ``segment=<first>-<last>`` folders, each with the rows of these
batches under their partition folders. A batch lands as a segment of its own. ``compact``
merges ``fan`` neighbouring segments of like size into one, so after n batches a
partition has about ``fan * log_fan(n)`` folders and a row is rewritten log_fan(n) times.

A folder becomes visible by one rename, when it is whole. A segment inside the range of
another is superseded: readers leave it out, and the next compaction deletes it, so a
reader that listed it before has a whole cycle to finish. A run killed at any point leaves
either the old segments or the new one for readers, and at most a hidden folder.
"""

from __future__ import annotations

import math
import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.sinks import write_partitioned

_SEGMENT = re.compile(r"segment=(\d+)-(\d+)")
Segment = tuple[int, int]


def _files(spark: SparkSession, path: str):
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), root


def segment_path(landing: str, segment: Segment) -> str:
    return f"{landing}/segment={segment[0]}-{segment[1]}"


def all_segments(spark: SparkSession, landing: str) -> list[Segment]:
    fs, root = _files(spark, landing)
    found = [_SEGMENT.fullmatch(s.getPath().getName()) for s in fs.listStatus(root)] if fs.exists(root) else []
    return sorted((int(m[1]), int(m[2])) for m in found if m)


def superseded(segments: list[Segment]) -> list[Segment]:
    """Segments whose batches another one holds as well."""
    widest, out = -1, []
    for lo, hi in sorted(segments, key=lambda s: (s[0], -s[1])):
        if hi <= widest:
            out.append((lo, hi))
        widest = max(widest, hi)
    return out


def live_segments(spark: SparkSession, landing: str) -> list[Segment]:
    found = all_segments(spark, landing)
    gone = set(superseded(found))
    return [s for s in found if s not in gone]


def _publish(spark: SparkSession, hidden: str, target: str) -> None:
    """One rename; a target that is already there is whole, so it stays."""
    fs, source = _files(spark, hidden)
    _, to = _files(spark, target)
    if fs.exists(to) or not fs.rename(source, to):
        fs.delete(source, True)
        if not fs.exists(to):
            raise OSError(f"{target} could not be put in place")


def landed(like: DataFrame, landing: str, segments: list[Segment] | None = None) -> DataFrame:
    """All landed rows, or those of some segments, with the columns of ``like`` and their ``batch``."""
    spark = like.sparkSession
    fields = [f for f in like.schema.fields if f.name != "batch"] + [T.StructField("batch", T.LongType())]
    paths = [segment_path(landing, s) for s in (live_segments(spark, landing) if segments is None else segments)]
    if not paths:
        return spark.createDataFrame([], T.StructType(fields))
    schema = T.StructType([*fields, T.StructField("segment", T.StringType())])
    return spark.read.schema(schema).option("basePath", landing).parquet(*paths).drop("segment")


def land_batch(batch: DataFrame, batch_id: int, landing: str, by: str = "order_month") -> DataFrame:
    """Write a micro-batch by partition and return it as landed. A replayed batch that has landed is left as it is."""
    spark = batch.sparkSession
    holding = [s for s in live_segments(spark, landing) if s[0] <= batch_id <= s[1]]
    if not holding:
        hidden = f"{landing}/_writing-{uuid.uuid4().hex}"
        write_partitioned(batch.withColumn("batch", F.lit(batch_id).cast("long")), hidden, by)
        _publish(spark, hidden, segment_path(landing, (batch_id, batch_id)))
        holding = [(batch_id, batch_id)]
    return landed(batch, landing, holding).where(F.col("batch") == batch_id)


def _run_to_merge(segments: list[Segment], sizes: dict[Segment, int], fan: int, full_bytes: int) -> list[Segment]:
    """The first ``fan`` neighbours of one level; full segments are left alone."""
    run: list[Segment] = []
    level = None
    for s in segments:
        now = None if sizes[s] >= full_bytes else int(math.log(s[1] - s[0] + 1, fan) + 1e-9)
        if now is None or now != level:
            run, level = [], now
        if now is not None:
            run.append(s)
        if len(run) == fan:
            return run
    return []


def compact(like: DataFrame, landing: str, by: str = "order_month", fan: int = 8, full_bytes: int = 64 << 30) -> list[Segment]:
    """Merge segments until no ``fan`` neighbours of a level are left; returns the live ones.

    Call it between batches, by the job that lands them. Merged files are rebalanced per
    partition, so many small files become few. Segments of ``full_bytes`` or more are not
    rewritten again.
    """
    spark = like.sparkSession
    fs, _ = _files(spark, landing)
    for s in superseded(all_segments(spark, landing)):
        fs.delete(_files(spark, segment_path(landing, s))[1], True)
    live = live_segments(spark, landing)
    sizes = {s: fs.getContentSummary(_files(spark, segment_path(landing, s))[1]).getLength() for s in live}
    while run := _run_to_merge(live, sizes, fan, full_bytes):
        merged = run[0][0], run[-1][1]
        hidden = f"{landing}/_writing-{uuid.uuid4().hex}"
        write_partitioned(landed(like, landing, run), hidden, by)
        _publish(spark, hidden, segment_path(landing, merged))
        sizes[merged] = sum(sizes[s] for s in run)
        live = sorted([s for s in live if s not in run] + [merged])
    return live
