"""Session defaults and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(app: str = "stratamart", master: str | None = None,
                  shuffle_partitions: int | None = None, **extra: str) -> SparkSession:
    """A session with the settings every job here relies on.

    Leave ``shuffle_partitions`` unset on a cluster only if the cluster's own
    default is already sized for its data: adaptive execution merges small
    shuffle partitions but never adds some to the planned number.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        "spark.sql.parquet.filterPushdown": "true",
        "spark.sql.parquet.aggregatePushdown": "true",
        "spark.ui.enabled": "false",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra)
    for k, v in conf.items():
        b = b.config(k, v)
    return b.getOrCreate()


def pin_utc(spark: SparkSession) -> SparkSession:
    """Timestamps in this package are UTC instants; make the session agree."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def work_dir(spark: SparkSession) -> str:
    """The shared folder for written intermediates.

    The cluster names it in ``spark.checkpoint.dir``. Only a local-mode
    session may fall back to a fresh temporary folder; on a cluster a folder
    of one machine would be lost with that machine, so that is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    root = tempfile.mkdtemp(prefix="run-", dir="/tmp" if os.path.isdir("/tmp") else None)
    spark.conf.set("spark.checkpoint.dir", root)
    spark.sparkContext.setCheckpointDir(root)
    return root


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path under the work folder that no other run has written to."""
    return f"{work_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
