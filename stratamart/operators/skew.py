"""Joins and numbering that survive one key holding a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import fresh_path


def stored(df: DataFrame, name: str) -> DataFrame:
    """Written under the shared folder and read back: every use sees the same rows."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def left_join_apart(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """``left LEFT JOIN right`` where one key may hold a large share of either side.

    Adaptive execution can split a hot key on the left side of a left join, never on the
    right. Here rows with a partner come from an inner join, where it may split both
    sides, and rows without one from an anti join against the right side's different keys,
    which merge inside each task before they are shuffled. Both use the same exchanges;
    nothing is sampled and planning runs no job.
    """
    keys = right.where(F.col(key).isNotNull()).select(key).distinct()
    empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in right.schema.fields if f.name != key]
    alone = left.join(keys, key, "left_anti").select("*", *empty)
    return left.join(right, key).unionByName(alone)


def position_in_group(df: DataFrame, group: str, ordinal: str, tiebreak: list[str], alias: str = "position") -> DataFrame:
    """0-based position of each row within its group, by an ordinal and ``tiebreak`` columns.

    A plain row number would sort a whole group in one task. The rows are range
    partitioned by (group, ordinal, tiebreak) and stored with the number of their
    range; they are numbered inside (group, range) and shifted by the group's rows
    in the ranges before. The window over ranges sees one row per range and group,
    however the ordinals are spread.
    """
    order = [group, ordinal, *[t for t in tiebreak if t not in (group, ordinal)]]
    ranged = stored(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "ranges")
    sizes = ranged.groupBy(group, "_range").agg(F.count("*").alias("_n"))
    before = W.partitionBy(group).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    shifts = sizes.select(F.col(group).alias("_g"), F.col("_range").alias("_r"),
                          F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"))
    inside = F.row_number().over(W.partitionBy(group, "_range").orderBy(*order[1:])) - 1
    numbered = ranged.withColumn("_in", inside)
    same = numbered[group].eqNullSafe(F.col("_g")) & (numbered["_range"] == F.col("_r"))
    return (numbered.join(shifts, same, "left")
            .withColumn(alias, (F.col("_in") + F.col("_shift")).cast("long"))
            .drop("_range", "_in", "_shift", "_g", "_r"))


def collect_members(df: DataFrame, group: str, ordinal: str, members: list[str]) -> DataFrame:
    """Group members in order (A13): one row per member with its 0-based position.

    The shape is the same for a group of any size; no value holds a whole group.
    Equal ordinals go by the members' own values.
    """
    placed = position_in_group(df.select(group, ordinal, *[m for m in members if m != ordinal]), group, ordinal, members)
    return placed.select(group, "position", *members)
