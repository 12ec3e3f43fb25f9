"""Small helpers shared by the text jobs: input columns, written intermediates, packed columns, running sums."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import fresh_path

BLOCK_BYTES = 12_000_000
SLICE_ROWS = 256


def doc_bytes(docs: DataFrame, *more: Column, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``doc_id`` long and ``text`` as UTF-8 bytes (null: empty), plus ``more``; every other column is left behind."""
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary").alias("text"), *more)


def text_mark(text: str = "text") -> Column:
    """A hash of the text (null: empty); with the id it tells the rows of a table apart, as an id may be missing or shared."""
    return F.xxhash64(F.coalesce(F.col(text).cast("string"), F.lit(""))).alias("mark")


def without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose id, null or not, and text are not among ``gone`` (doc_id, mark), with all their columns."""
    left = docs.withColumn("_row_mark", text_mark())
    right = gone.select(F.col("doc_id").alias("_gone_id"), F.col("mark").alias("_gone_mark")).distinct()
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("_gone_id")) & (F.col("_row_mark") == F.col("_gone_mark"))
    return left.join(right, same, "left_anti").drop("_row_mark")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to the cluster's shared folder and read back: later jobs survive lost executors and reuse the rows."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def id_remainder(modulus: int, doc_id: str = "doc_id") -> Column:
    """crc32 of the decimal text of the id, modulo ``modulus``; a missing id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % modulus


def partitions_of(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def block_count(docs: DataFrame, text: str = "text", block_bytes: int = BLOCK_BYTES) -> int:
    """How many blocks of about ``block_bytes`` of text the table makes."""
    total = docs.agg(F.sum(F.octet_length(F.col(text).cast("string")))).first()[0] or 0
    return max(partitions_of(docs.sparkSession), -(-total // block_bytes))


def block_of(n: int, doc_id: str = "doc_id", text: str = "text") -> Column:
    """A block number that depends on the row alone, so a recomputed task deals the same blocks."""
    return F.pmod(F.xxhash64(F.col(doc_id), F.substring(F.col(text), 1, 64)), F.lit(n)).cast("int")


def slices(batch: pa.RecordBatch, rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """Parts of an Arrow batch, not copied: Python objects are made of the values of a few rows at a time, not of a whole batch."""
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def packed(a: np.ndarray) -> bytes:
    return np.ascontiguousarray(a).tobytes()


def sha256_hex(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalizer of splitmix64 over an array of uint64."""
    with np.errstate(over="ignore"):
        x = x ^ (x >> np.uint64(30))  # the only copy
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
        return x


def running_before(df: DataFrame, group: str, order: list[str], value: str, out: str, cell: Column) -> DataFrame:
    """Sum of ``value`` over the rows before each one, per ``group`` in ``order``.

    ``cell`` is a long that never decreases along ``order``. Rows are summed per
    (group, cell), the few cell sums are accumulated in one window, and only the
    rows of one cell meet in a task, so a group of any size is spread out. Null
    groups are a group of their own.
    """
    df = df.withColumn("_cell", cell)
    sums = df.groupBy(group, "_cell").agg(F.sum(value).alias("_sum"))
    over = Window.partitionBy(group).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(F.col(group).alias("_g"), F.col("_cell").alias("_c"),
                         F.coalesce(F.sum("_sum").over(over), F.lit(0)).alias("_start"))
    inside = Window.partitionBy(group, "_cell").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (df.join(starts, F.col(group).eqNullSafe(F.col("_g")) & (F.col("_cell") == F.col("_c")))
              .withColumn(out, F.col("_start") + F.coalesce(F.sum(value).over(inside), F.lit(0)))
              .drop("_cell", "_g", "_c", "_start"))
