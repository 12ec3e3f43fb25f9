"""Query-log jobs (D18-D20) and usage-based lineage."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.display import (cache_rate, email_local_part, human_bytes, human_datetime, human_duration,
                                 preview, truncated)
from .predicates import within_days

# Window and length of the job history.
HISTORY_DAYS, HISTORY_ROWS = 7, 50


def job_history(log: DataFrame, as_of: dt.datetime | Column, days: int = HISTORY_DAYS,
                rows: int | None = HISTORY_ROWS) -> DataFrame:
    """Newest query jobs of the window; a top-k, so no global sort. ``rows=None`` keeps all."""
    kept = log.where(within_days(F.col("creation_time"), as_of, days) & (F.col("job_type") == "QUERY"))
    shown = kept if rows is None else kept.orderBy(F.col("creation_time").desc(), F.col("job_id")).limit(rows)
    return shown.withColumn("query_preview", preview(F.col("query"))).drop("query")


def job_summary(jobs: DataFrame) -> DataFrame:
    cached = F.count_if(F.col("cache_hit"))
    zero = lambda c: F.coalesce(c, F.lit(0))
    return jobs.agg(
        F.count("*").alias("total"), F.count_distinct("user_email").alias("unique_users"),
        F.count_if(F.col("state") == "DONE").alias("successful"), cached.alias("cached"),
        cache_rate(cached, F.count("*")).alias("cache_rate"),
        zero(F.sum("bytes_processed")).alias("total_bytes"), zero(F.sum("bytes_billed")).alias("total_billed"))


def job_list(jobs: DataFrame) -> DataFrame:
    """Display columns of the history."""
    return jobs.select(
        "job_id", human_datetime(F.col("creation_time")).alias("started"),
        F.coalesce(email_local_part(F.col("user_email")), F.lit("-")).alias("user"),
        F.coalesce("statement_type", "job_type").alias("statement"), "state",
        human_bytes(F.col("bytes_processed")).alias("processed"), human_bytes(F.col("bytes_billed")).alias("billed"),
        human_duration(F.col("creation_time"), F.col("end_time")).alias("duration"),
        F.when(F.col("cache_hit"), "Y").otherwise("-").alias("cached"),
        F.coalesce(F.size("referenced_tables"), F.lit(0)).alias("tables"),
        truncated(F.trim("query_preview"), 80).alias("preview"))


def usage_edges(jobs: DataFrame) -> DataFrame:
    """Table edges actually used: each referenced table feeds the job's destination."""
    name = lambda t: F.concat_ws(".", t["dataset_id"], t["table_id"])
    used = jobs.where(F.col("destination_table").isNotNull()).select(
        F.explode("referenced_tables").alias("r"), "destination_table", "end_time")
    return used.groupBy(name(F.col("r")).alias("upstream"), name(F.col("destination_table")).alias("downstream")).agg(
        F.count("*").alias("jobs"), F.max("end_time").alias("last_used"))
