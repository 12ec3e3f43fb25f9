"""Declared keys checked against the data.

Keys are declared, not enforced, so they can be wrong. Every check starts from
the same table of counts per key, reduced inside each task before the shuffle.
Checks that share a table and key ask for the same shuffle, which Spark then does
once, and a child's and its parent's counts meet without another one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def key_counts(df: DataFrame, *key: str) -> DataFrame:
    """Rows per key, a missing key included."""
    return df.groupBy(*key).agg(F.count("*").alias("n"))


def primary_key_check(df: DataFrame, name: str, *key: str) -> DataFrame:
    """One row: NULL keys, keys that occur more than once, rows under such keys."""
    complete = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in key])
    per_key = key_counts(df, *key)
    repeated = complete & (F.col("n") > 1)
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("checked_rows"),
        F.coalesce(F.sum(F.when(~complete, F.col("n"))), F.lit(0)).alias("null_key_rows"),
        F.count_if(repeated).alias("violating_keys"),
        F.coalesce(F.sum(F.when(repeated, F.col("n"))), F.lit(0)).alias("violating_rows"),
        F.min(F.when(repeated, F.concat_ws(",", *key))).alias("sample_key"),
    ).select(F.lit(name).alias("constraint_name"), F.lit("PRIMARY KEY").alias("constraint_type"), "*")


def foreign_key_orphans(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Distinct child keys without a parent, with their row counts; NULL keys are no orphans."""
    keys, parents = _child_and_parent(child, child_key, parent, parent_key)
    return keys.where(F.col("_k").isNotNull()).join(parents, "_k", "left_anti").select(F.col("_k").alias("key"), "n")


def _child_and_parent(child, child_key, parent, parent_key) -> tuple[DataFrame, DataFrame]:
    return (key_counts(child, child_key).withColumnRenamed(child_key, "_k"),
            key_counts(parent, parent_key).select(F.col(parent_key).alias("_k"), F.col("n").alias("_parents")))


def foreign_key_check(child: DataFrame, name: str, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """One row, in the layout of ``primary_key_check``."""
    keys, parents = _child_and_parent(child, child_key, parent, parent_key)
    orphan = F.col("_k").isNotNull() & F.col("_parents").isNull()
    return keys.join(parents, "_k", "left").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("checked_rows"),
        F.coalesce(F.sum(F.when(F.col("_k").isNull(), F.col("n"))), F.lit(0)).alias("null_key_rows"),
        F.count_if(orphan).alias("violating_keys"),
        F.coalesce(F.sum(F.when(orphan, F.col("n"))), F.lit(0)).alias("violating_rows"),
        F.min(F.when(orphan, F.col("_k").cast("string"))).alias("sample_key"),
    ).select(F.lit(name).alias("constraint_name"), F.lit("FOREIGN KEY").alias("constraint_type"), "*")


def violating_keys(violations: DataFrame, name: str, keys: list[str], samples: int = 10) -> DataFrame:
    """Up to ``samples`` keys of one violated constraint, those with the most rows first, then by the key's text.

    ``violations`` has a row per violating key with its rows ``n``. The limit is the report's
    and each task sends no more than that many rows.
    """
    text = F.concat_ws(",", *keys)
    return violations.select(F.lit(name).alias("constraint_name"), text.alias("key"), "n").orderBy(F.desc("n"), "key").limit(samples)


def repeated_keys(df: DataFrame, *key: str) -> DataFrame:
    """Complete keys that occur more than once, with their rows."""
    complete = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in key])
    return key_counts(df, *key).where(complete & (F.col("n") > 1))


def constraint_report(*checks: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)
