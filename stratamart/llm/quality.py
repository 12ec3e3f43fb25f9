"""Quality classifier: random Fourier features of document statistics, ridge regression, isotonic calibration.

Statistics are computed once per text and stored. Means, deviations and the
normal equations are sums over partitions, so fitting takes every labelled
training row however many there are; only matrices of fixed size reach the
driver. Three quarters of the training rows fit the ridge, the last quarter
calibrates it.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import doc_bytes, id_remainder, stored
from .linear import isotonic, matrix_sum, ridge, stack

FEATURES = 256
PENALTY = 1.0
BINS = 2000
SEED = 20240607
HELD_OUT = 5

_KIND = np.zeros(256, np.uint8)  # 1 upper, 2 lower, 3 digit, 4 white space, 5 usual marks, 6 other marks, 7 control, 8 beyond ASCII
_KIND[65:91], _KIND[97:123], _KIND[48:58] = 1, 2, 3
_KIND[[32, 9, 10, 11, 12, 13]] = 4
for _c in range(33, 127):
    if _KIND[_c] == 0:
        _KIND[_c] = 5 if chr(_c) in ".,;:'\"?-()" else 6
_KIND[:9], _KIND[14:32], _KIND[127], _KIND[128:] = 7, 7, 7, 8

NAMES = ("log_words", "log_bytes", "word_length", "word_length_deviation", "upper", "digits", "white", "marks", "symbols",
         "control", "beyond_ascii", "symbol_words", "short_words", "distinct_words", "commonest_word", "repeats_next",
         "repeats_pair", "shouted_words", "log_lines", "line_words", "repeated_lines", "sentence_ends", "entropy", "longest_word")


def statistics(text: bytes) -> list[float]:
    """The numbers of NAMES for one whole text; an empty text has zeros."""
    words = text.split()
    n, size = len(words), len(text)
    if n == 0:
        return [0.0, math.log1p(size)] + [0.0] * (len(NAMES) - 2)
    raw = np.frombuffer(text, np.uint8)
    bytes_of = np.bincount(raw, minlength=256)
    kinds = np.bincount(_KIND, weights=bytes_of, minlength=9) / size
    lengths = np.fromiter(map(len, words), np.int64, n)
    counts: dict[bytes, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    same_next = sum(map(bytes.__eq__, words, words[1:])) / n
    same_pair = sum(map(bytes.__eq__, words, words[2:])) / n
    shouted = sum(map(bytes.isupper, words)) / n
    symbol_words = sum(c for w, c in counts.items() if _KIND[w[-1]] == 6 or _KIND[w[0]] == 6) / n if kinds[6] else 0.0
    lines = [x for x in text.split(b"\n") if x.strip()]
    p = bytes_of[bytes_of > 0] / size
    return [math.log1p(n), math.log1p(size), lengths.mean(), lengths.std(), kinds[1], kinds[3], kinds[4], kinds[5], kinds[6],
            kinds[7], kinds[8], symbol_words, float((lengths <= 2).mean()), len(counts) / n, max(counts.values()) / n,
            same_next, same_pair, shouted, math.log1p(len(lines)), math.log1p(n / max(1, len(lines))),
            1 - len(set(lines)) / max(1, len(lines)), text.count(b".") / n, float(-(p * np.log2(p)).sum()), math.log1p(int(lengths.max()))]


def _describe(batches):
    for b in batches:
        rows = [np.array(statistics(t)).tobytes() for t in b.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("remainder"), pa.array(rows, pa.binary())],
                                         names=["doc_id", "remainder", "stats"])


class Model:
    """Standardisation, random Fourier map, ridge weights and calibration curve."""

    def __init__(self, mean, deviation, features: int, seed: int):
        rng = np.random.default_rng(seed)
        d = len(mean)
        self.mean, self.deviation = mean, deviation
        self.directions = rng.normal(size=(d, features)) / math.sqrt(d)
        self.phases = rng.uniform(0, 2 * math.pi, features)
        self.weights, self.curve = None, None

    def map(self, stats: np.ndarray) -> np.ndarray:
        z = np.clip((stats - self.mean) / self.deviation, -8, 8)
        waves = np.cos(z @ self.directions + self.phases) * math.sqrt(2.0 / len(self.phases))
        return np.hstack([waves, np.ones((len(stats), 1))])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.map(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        raw = self.raw(stats)
        if self.curve is None:
            return np.clip(raw, 0.0, 1.0)
        x, y = self.curve
        # the curve decides; the raw score orders what the curve holds equal
        return np.clip(0.999 * np.interp(raw, x, y) + 0.001 / (1 + np.exp(-4 * (raw - 0.5))), 0.0, 1.0)


def fit(labelled: DataFrame, features: int = FEATURES, penalty: float = PENALTY, seed: int = SEED, bins: int = BINS) -> Model:
    """Fit on rows (stats, label 0/1, calibrate boolean), all of them."""
    width = len(NAMES)

    def moments(b):
        x = stack(b.column("stats"), width)
        return np.vstack([np.full(width, float(len(x))), x.sum(0), (x * x).sum(0)])

    n, s, q = matrix_sum(labelled, (3, width), moments)
    mean = s / np.maximum(n, 1)
    deviation = np.sqrt(np.maximum(q / np.maximum(n, 1) - mean * mean, 1e-12))
    model = Model(mean, np.where(deviation < 1e-5, 1.0, deviation), features, seed)
    size = features + 1

    def equations(b):
        x = model.map(stack(b.column("stats"), width))
        y = np.asarray(b.column("label").to_pylist(), float)
        return np.vstack([x.T @ x, x.T @ y])

    sums = matrix_sum(labelled.filter("NOT calibrate"), (size + 1, size), equations)
    if sums[size - 1, size - 1] == 0:  # no labelled row
        model.weights = np.append(np.zeros(features), 0.5)
        return model
    model.weights = ridge(sums[:size], sums[size], penalty)
    edges = np.linspace(-1, 2, bins + 1)

    def curve(b):
        at = np.clip(np.searchsorted(edges, model.raw(stack(b.column("stats"), width))) - 1, 0, bins - 1)
        y = np.asarray(b.column("label").to_pylist(), float)
        return np.vstack([np.bincount(at, y, bins), np.bincount(at, minlength=bins)])

    positives, counts = matrix_sum(labelled.filter("calibrate"), (2, bins), curve)
    if counts.sum() > 0:
        model.curve = isotonic((edges[1:] + edges[:-1]) / 2, positives, counts)
    return model


def quality_scores(docs: DataFrame, labels: DataFrame, held_out: int = HELD_OUT, cut: float = 0.3) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted.

    Learns from labelled rows whose id remainder modulo ``held_out`` is not 0; the
    remainder ``held_out - 1`` calibrates. Null text is empty and is scored like any
    other; null labels and ids teach nothing; a repeated label counts again. Without
    labels every score is 0.5. Extra columns are ignored; an empty table gives no rows.
    """
    rows = doc_bytes(docs, id_remainder(held_out).cast("int").alias("remainder"))
    stats = stored(rows.mapInArrow(_describe, "doc_id long, remainder int, stats binary"), "quality-stats")
    marked = labels.filter("quality IS NOT NULL").select(F.col("doc_id").cast("long").alias("_id"), F.col("quality").cast("int").alias("label"))
    labelled = stored(stats.filter("remainder <> 0").join(marked, F.col("doc_id") == F.col("_id")).select(
        "stats", "label", (F.col("remainder") == held_out - 1).alias("calibrate")), "quality-labelled")
    model = fit(labelled)

    def score(batches):
        for b in batches:
            s = model.score(stack(b.column("stats"), len(NAMES)))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([r == 0 for r in b.column("remainder").to_pylist()], pa.bool_()),
                                              pa.array(s, pa.float64()), pa.array((s >= cut).astype(np.int32), pa.int32())],
                                             names=["doc_id", "held_out", "score", "predicted"])
    return stats.mapInArrow(score, "doc_id long, held_out boolean, score double, predicted int")
