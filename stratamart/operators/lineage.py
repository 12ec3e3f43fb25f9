"""Lineage edges and walks over them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..session import fresh_path
from .skew import stored

EDGE = ["upstream", "downstream", "transform"]


def edges_from(spark: SparkSession, rows: list[tuple[str, str, str]]) -> DataFrame:
    """A short literal edge list; the ordinal keeps the listing order, which "first edge" depends on."""
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)],
                                 "ordinal long, upstream string, downstream string, transform string")


def _steps(edges: DataFrame, first_only: bool) -> DataFrame:
    """Both directions in one table, from one pass: (side, at, next, edge), for ``first_only`` the first edge of a node."""
    e = edges.select("ordinal", *EDGE) if first_only else edges.select(*EDGE)
    both = e.select("*", F.inline(F.array(
        F.struct(F.lit("up").alias("side"), F.col("downstream").alias("at")),
        F.struct(F.lit("down").alias("side"), F.col("upstream").alias("at"))))).where(F.col("at").isNotNull())
    if first_only:
        best = F.min(F.struct("ordinal", *EDGE)).alias("e")
        both = both.groupBy("side", "at").agg(best).select("side", "at", *[F.col(f"e.{c}") for c in EDGE])
    return both.withColumn("next", F.when(F.col("side") == "up", F.col("upstream")).otherwise(F.col("downstream")))


def _counted(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """``stored`` and how many rows it wrote, without a further job."""
    seen = Observation()
    return stored(df.observe(seen, F.count("*").alias("n")), name), seen.get["n"]


def _follow(starts: DataFrame, steps: DataFrame, hops: int | None) -> DataFrame:
    """(side, start, node, hop) of every node on the one way on from each start, by doubling the jumps.

    After k rounds the jump table holds each node's 2^k-th successor, so a chain of
    any depth takes log2(depth) rounds of two joins. Jumps end when no chain is
    that long. Where a cycle keeps them alive, a node is kept at its least hop and the
    rounds end when they bring no new node.
    """
    jump, left = steps.select("side", "at", "next"), 1
    sides = starts.select(F.explode(F.array(F.lit("up"), F.lit("down"))).alias("side"), "start")
    found, known = _counted(sides.distinct().withColumns({"node": F.col("start"), "hop": F.lit(0).cast("long")}), "walk")
    length = 1
    while left and (hops is None or length < hops):
        ahead = found.join(jump.withColumnsRenamed({"at": "node", "next": "_next"}), ["side", "node"]).select(
            "side", "start", F.col("_next").alias("node"), (F.col("hop") + length).alias("hop"))
        found, now = _counted(found.unionByName(ahead).groupBy("side", "start", "node").agg(F.min("hop").alias("hop")), "walk")
        if now == known:
            break
        known, length = now, 2 * length
        onward = jump.select("side", F.col("at").alias("next"), F.col("next").alias("_far"))
        jump, left = _counted(jump.join(onward, ["side", "next"]).select("side", "at", F.col("_far").alias("next")), "jump")
    return found


def _onward(steps: DataFrame) -> DataFrame:
    """(side, at, next) of the edges that lead to a node with a further edge.

    A trace lists the edges that leave its nodes, and a dead end has none, so no walk needs to enter it.
    """
    leaving = steps.select("side", F.col("at").alias("next")).distinct()
    return steps.select("side", "at", "next").join(leaving, ["side", "next"], "left_semi")


def _spread(starts: DataFrame, steps: DataFrame, hops: int | None) -> DataFrame:
    """(side, start, node, hop) of every node reached over any of the steps, hop by hop, until no start reaches anything new."""
    spark = starts.sparkSession
    sides = starts.select(F.explode(F.array(F.lit("up"), F.lit("down"))).alias("side"), "start")
    paths = []

    def keep(df: DataFrame) -> tuple[DataFrame, int]:
        seen, path = Observation(), fresh_path(spark, "reached")
        df.observe(seen, F.count("*").alias("n")).write.parquet(path)
        paths.append(path)
        return spark.read.schema(df.schema).parquet(path), seen.get["n"]

    new, n = keep(sides.distinct().withColumns({"node": F.col("start"), "hop": F.lit(0).cast("long")}))
    schema, hop = new.schema, 0
    while n and (hops is None or hop < hops - 1):
        hop += 1
        reached = spark.read.schema(schema).parquet(*paths).select("side", "start", "node")
        ahead = new.join(steps.select("side", F.col("at").alias("node"), F.col("next").alias("_next")), ["side", "node"]).select(
            "side", "start", F.col("_next").alias("node")).distinct()
        new, n = keep(ahead.join(reached, ["side", "start", "node"], "left_anti").withColumn("hop", F.lit(hop).cast("long")))
    return spark.read.schema(schema).parquet(*paths)


def trace(edges: DataFrame, starts: DataFrame, first_only: bool = True, hops: int | None = None) -> DataFrame:
    """Everything upstream and downstream of every start node, as (start, direction, position, edge).

    ``first_only`` follows the first edge of a node only, which makes a chain in
    each direction; otherwise all edges are followed, the full closure. A cycle
    ends where it meets a node already reached; its closing edge is reported.
    ``hops`` bounds the walk, by default it goes on until nothing new is found.
    ``position`` is minus the hop upstream and the hop downstream. Steps, jumps and rounds
    are written, so neither the plan nor the work on the edges grows with their number.
    """
    steps = stored(_steps(edges, first_only), "steps")
    reached = _follow(starts, steps, hops) if first_only else _spread(starts, stored(_onward(steps), "onward"), hops)
    if hops is not None:
        reached = reached.where(F.col("hop") < hops)
    sign = F.when(F.col("side") == "up", -1).otherwise(1)
    return reached.withColumnRenamed("node", "at").join(steps, ["side", "at"]).select(
        "start", F.col("side").alias("direction"), (sign * (F.col("hop") + 1)).cast("long").alias("position"), *EDGE)


def neighbourhood(edges: DataFrame, node: str) -> DataFrame:
    """The node and everything one edge away."""
    near = edges.where((F.col("upstream") == node) | (F.col("downstream") == node))
    return near.select(F.explode(F.array("upstream", "downstream")).alias("node")).distinct()


def node_names(edges: DataFrame) -> DataFrame:
    """Every node that occurs on either side, once."""
    return edges.select("upstream").union(edges.select("downstream")).distinct().toDF("node")


def edge_volumes(edges: DataFrame, tables: DataFrame) -> DataFrame:
    """Edges with the row counts of both ends (NULL where a table is not in the inventory)."""
    size = tables.select(F.concat_ws(".", "dataset_id", "table_name").alias("node"), "num_rows")
    return (edges.join(size.select(F.col("node").alias("upstream"), F.col("num_rows").alias("upstream_rows")),
                       "upstream", "left")
            .join(size.select(F.col("node").alias("downstream"), F.col("num_rows").alias("downstream_rows")),
                  "downstream", "left"))
