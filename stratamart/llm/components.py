"""Connected components of a link table by alternating large and small stars, after union-find inside each task."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

_EDGE = "u long, v long"


def _contract(batches):
    """Union-find over the links of one task: the same connections as one link per node to its least neighbour."""
    parent: dict[int, int] = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for b in batches:
        for u, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            a, c = root(u), root(v)
            if a != c:
                parent[max(a, c)] = min(a, c)
    links = [(x, root(x)) for x in parent]
    links = [x for x in links if x[0] != x[1]]
    yield pa.RecordBatch.from_arrays([pa.array(np.array([x[i] for x in links], np.int64)) for i in range(2)], names=["u", "v"])


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
    return both.filter("v > u").join(least, F.col("u") == F.col("w")).select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), "m")
    moved = edges.join(least, F.col("u") == F.col("w")).filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select(F.col("w").alias("u"), F.col("m").alias("v")))


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(links: DataFrame) -> DataFrame:
    """Rows (node, component) for every node of ``links`` (u, v); the component is its least node.

    Each round is written to the shared folder and ends when it changes nothing. A
    node with very many links is summed up inside the tasks first, and the join that
    moves its links has one row on its other side, so it can be split.
    """
    edges = stored(links.select("u", "v").mapInArrow(_contract, _EDGE).distinct(), "links")
    before = _state(edges)
    while before[0]:
        edges = stored(_small_star(_large_star(edges).distinct()).distinct(), "links")
        after = _state(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("v").alias("node")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component")))
