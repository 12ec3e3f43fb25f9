"""Marts kept current from arrivals."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..plans.staging import stg_orders
from ..plans.upkeep import refresh_daily_summary, touched_values, with_month
from ..sources.sinks import write_partitioned
from .landing import compact, land_batch, landed


def keep_daily_summary(raw_orders: DataFrame, landing: str, summary: str, checkpoint: str,
                       stage: Callable[[DataFrame], DataFrame] = stg_orders, fan: int = 8) -> StreamingQuery:
    """Land staged orders and recompute the summary of the months they touch.

    No state is kept between batches: a day is always recomputed from every
    landed order of that day, and only the touched months are read. Landed segments
    are merged ``fan`` at a time. Runs to the end of the available input and stops.
    """
    def on_batch(batch: DataFrame, batch_id: int) -> None:
        staged = with_month(stage(batch))
        new = land_batch(staged, batch_id, landing)
        refresh_daily_summary(landed(staged, landing), new, summary)
        compact(staged, landing, fan=fan)

    return (raw_orders.writeStream.foreachBatch(on_batch).outputMode("append")
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def keep_customer_360(arrivals: DataFrame, landing: str, customers: Callable[[], DataFrame],
                      build: Callable[[DataFrame, DataFrame], DataFrame], path: str, checkpoint: str,
                      buckets: int = 64, fan: int = 8) -> StreamingQuery:
    """Land new orders and recompute the customers they name, in a mart stored by customer bucket.

    Landing and refresh are one step of one stream, so no order is refreshed before
    it has landed. Orders are landed by bucket and only the touched buckets are read.
    Parquet replaces whole partitions, so the unit of refresh is the bucket: with B
    buckets a batch of few customers rewrites few of them; choose B so that a bucket
    is about a file. ``customers`` returns the staged customers as of now; where they
    are stored by ``bucket``, they are pruned too.
    """
    def on_batch(batch: DataFrame, batch_id: int) -> None:
        keyed = batch.withColumn("bucket", customer_bucket(buckets))
        new = land_batch(keyed, batch_id, landing, "bucket")
        touched = touched_values(new, "bucket")
        if not touched:
            return

        def pick(df: DataFrame) -> DataFrame:
            bucketed = df if "bucket" in df.columns else df.withColumn("bucket", customer_bucket(buckets))
            return bucketed.where(F.col("bucket").isin(touched)).drop("bucket", "batch")

        fresh = build(pick(customers()), pick(landed(keyed, landing))).withColumn("bucket", customer_bucket(buckets))
        write_partitioned(fresh, path, "bucket", dynamic=True)
        compact(keyed, landing, "bucket", fan)

    return (arrivals.writeStream.foreachBatch(on_batch).outputMode("append")
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def customer_bucket(buckets: int):
    return F.pmod(F.xxhash64("customer_id"), F.lit(buckets)).cast("int").alias("bucket")
