"""Sums of small matrices over all rows of a table, the only thing the model fits here gather."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame


def matrix_sum(df: DataFrame, shape: tuple[int, int], per_batch) -> np.ndarray:
    """Sum of ``per_batch(record batch)`` over all batches, an array of ``shape``.

    A task adds up its batches and sends the rows of its sum; Spark adds the sums
    row by row. The driver gets one matrix of the fixed shape.
    """
    def partial(batches):
        total = np.zeros(shape)
        for b in batches:
            if b.num_rows:
                total += per_batch(b)
        yield pa.RecordBatch.from_arrays([pa.array(range(shape[0]), pa.int32()), pa.array([r.tobytes() for r in total], pa.binary())],
                                         names=["i", "row"])

    def add(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape[1])
        for b in batches:
            for r in b.column("row"):
                total += np.frombuffer(r.as_py())
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([total.tobytes()], pa.binary())],
                                         names=["i", "row"])

    rows = df.mapInArrow(partial, "i int, row binary").groupBy("i").applyInArrow(add, "i int, row binary")
    out = np.zeros(shape)
    for r in rows.collect():
        out[r["i"]] = np.frombuffer(r["row"])
    return out


def stack(column: pa.Array, width: int) -> np.ndarray:
    """Packed float64 rows of a binary column as a matrix."""
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(-1, width)


def ridge(gram: np.ndarray, moment: np.ndarray, penalty: float) -> np.ndarray:
    """Solve the normal equations with a penalty on all but the last (constant) weight."""
    d = np.full(len(gram), penalty)
    d[-1] = 1e-9
    return np.linalg.solve(gram + np.diag(d), moment)


def isotonic(x: np.ndarray, positives: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators over sorted bins; (block centre, block mean) for interpolation."""
    blocks: list[list[float]] = []
    for xi, p, c in zip(x, positives, counts):
        if c == 0:
            continue
        blocks.append([xi * c, p, c])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    return np.array([b[0] / b[2] for b in blocks]), np.array([b[1] / b[2] for b in blocks])
