"""Name -> (Spark query, check SQL)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Runner = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    run: Runner
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None) -> Callable[[Runner], Runner]:
    """Register a query under its inventory name. Without SQL only its rows are checked by tests."""
    def add(fn: Runner) -> Runner:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(lambda spark, sf_dir: comparable(fn(spark, sf_dir)), sql)
        return fn
    return add


def comparable(df: DataFrame) -> DataFrame:
    """Types both engines agree on: decimals as doubles, integers as bigint, instants without zone."""
    def out(f: T.StructField):
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DecimalType, T.FloatType)):
            c = c.cast("double")
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        elif isinstance(f.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        return c.alias(f.name)
    return df.select(*[out(f) for f in df.schema.fields])


def runners() -> dict[str, Runner]:
    return {n: q.run for n, q in REGISTRY.items()}


def oracles() -> dict[str, str]:
    return {n: q.sql for n, q in REGISTRY.items() if q.sql}
