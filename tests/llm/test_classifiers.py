import zlib

import numpy as np
import pytest

from stratamart.llm import linear as L
from stratamart.llm import quality as Q
from stratamart.llm import toxicity as T

SF = "/root/testdata/sf0.01"


def held_out_accuracy(scores, labels, column):
    rows = scores.filter("held_out").join(labels, "doc_id").select("predicted", column).collect()
    return sum(r[0] == r[1] for r in rows) / len(rows)


def test_quality_on_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    scores = Q.quality_scores(docs, labels).cache()
    assert held_out_accuracy(scores, labels, "quality") >= 0.95
    for r in scores.collect():
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)


def test_toxicity_on_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    scores = T.toxicity_scores(docs, labels).cache()
    assert held_out_accuracy(scores, labels, "toxic") >= 0.9
    clean = scores.join(labels.filter("toxic = 0"), "doc_id")
    assert clean.filter("predicted = 1").count() <= 0.01 * clean.count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in scores.collect())


def test_held_out_labels_are_not_read(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    flipped = labels.withColumn("quality", Q.F.when(Q.id_remainder(5) == 0, 1 - Q.F.col("quality")).otherwise(Q.F.col("quality")))
    key = lambda r: r["doc_id"]
    a, b = (sorted(Q.quality_scores(docs, x).collect(), key=key) for x in (labels, flipped))
    assert [r["score"] for r in a] == pytest.approx([r["score"] for r in b], abs=1e-6)


@pytest.mark.parametrize("scores", [Q.quality_scores, T.toxicity_scores])
def test_messy_empty_and_no_labels(spark, messy, messy_rows, empty, scores):
    labels = spark.createDataFrame([(1, 1, 0), (3, 1, None), (4, None, 1), (14, 0, 1), (14, 0, 1), (None, 1, 1), (99, 1, 1)], "doc_id long, quality int, toxic int")
    for own in (labels, labels.filter("doc_id < 0")):
        rows = scores(messy, own).collect()
        assert len(rows) == len(messy_rows) and all(0 <= r["score"] <= 1 for r in rows)
    assert scores(empty, labels).count() == 0
    assert T.drop_toxic(messy, labels).columns == messy.columns


def test_label_model_shares_weight_among_copied_voters(spark):
    rng = np.random.default_rng(0)
    y = rng.random(4000) < 0.3
    fire = lambda hit, miss: np.where(y, rng.random(4000) < hit, rng.random(4000) < miss)
    a, b, c = fire(0.7, 0.05), fire(0.6, 0.1), fire(0.5, 0.02)
    votes = np.stack([a, a, a, b, c], 1)
    patterns, n = np.unique(votes, axis=0, return_counts=True)
    df = spark.createDataFrame([(bytearray(p.astype(float).tobytes()), int(k)) for p, k in zip(patterns, n)], "votes binary, n long")
    seen = np.array([[70, 4, 4, 4, 7, 1, 59], [30, 21, 21, 21, 18, 15, 2]], float)
    model = T.fit_label_model(df, seen, 5)
    assert model.share[:3].max() < 0.5 < model.share[3:].min()
    assert model.toxic[0] == pytest.approx(0.7, abs=0.1) and model.clean[0] == pytest.approx(0.05, abs=0.04)
    assert ((model.posterior(votes.astype(float)) > 0.5) == y).mean() > 0.85


def test_isotonic_is_the_best_monotone_fit():
    x, y = L.isotonic(np.arange(6.0), np.array([1.0, 0, 2, 1, 3, 3]), np.array([2.0, 1, 4, 0, 3, 3]))
    assert list(y) == pytest.approx([1 / 3, 0.5, 1.0]) and list(x) == pytest.approx([1 / 3, 2, 4.5])
    assert all(np.diff(y) >= 0)


def test_statistics_of_odd_texts():
    for t in (b"", b" \n", b"a", b"\x00\xff", b"word " * 50_000):
        assert len(Q.statistics(t)) == len(Q.NAMES) and np.isfinite(Q.statistics(t)).all()


def test_quality_fit_is_plain_ridge(spark):
    """Partition sums and one process over all rows give the same weights and calibration counts."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(500, len(Q.NAMES)))
    y = (x[:, 0] + 0.3 * rng.normal(size=500) > 0).astype(int)
    calibrate = rng.random(500) < 0.25
    df = spark.createDataFrame([(r.tobytes(), int(v), bool(c)) for r, v, c in zip(x, y, calibrate)], "stats binary, label int, calibrate boolean").repartition(6)
    model = Q.fit(df)
    assert np.allclose(model.mean, x.mean(0)) and np.allclose(model.deviation, x.std(0))
    own = Q.Model(x.mean(0), x.std(0), Q.FEATURES, Q.SEED)
    phi = own.map(x[~calibrate])
    penalty = np.full(phi.shape[1], Q.PENALTY)
    penalty[-1] = 1e-9
    want = np.linalg.solve(phi.T @ phi + np.diag(penalty), phi.T @ y[~calibrate])
    assert np.allclose(model.weights, want, rtol=1e-5, atol=1e-7)
    own.weights = want
    raw = own.raw(x[calibrate])
    edges = np.linspace(-1, 2, Q.BINS + 1)
    at = np.clip(np.searchsorted(edges, raw) - 1, 0, Q.BINS - 1)
    curve = L.isotonic((edges[1:] + edges[:-1]) / 2, np.bincount(at, y[calibrate], Q.BINS), np.bincount(at, minlength=Q.BINS))
    assert np.allclose(model.curve[0], curve[0]) and np.allclose(model.curve[1], curve[1])


def test_toxicity_fit_against_one_process(spark):
    """EM over vote patterns and Newton steps over partition sums, against the same sums over all rows at once."""
    rng = np.random.default_rng(5)
    width, n = 4, 600
    y = rng.random(n) < 0.3
    hits = np.where(y[:, None], rng.poisson(1.2, (n, width)), rng.poisson(0.1, (n, width))).astype(float)
    hits = np.hstack([hits, rng.integers(20, 200, (n, 1))])
    votes = hits[:, :-1] > 0
    patterns, count = np.unique(votes, axis=0, return_counts=True)
    pdf = spark.createDataFrame([(v.astype(float).tobytes(), int(k)) for v, k in zip(patterns, count)], "votes binary, n long").repartition(3)
    known = rng.random(n) < 0.4
    fired = votes.astype(float)
    seen = np.vstack([[w.sum(), *(w @ fired), w @ ~votes.any(1)] for w in ((known & ~y).astype(float), (known & y).astype(float))])
    model = T.fit_label_model(pdf, seen, width, rounds=3)
    (n0, *f0, none0), (n1, *f1, none1) = seen
    f0, f1 = np.array(f0), np.array(f1)
    silent = (none1 + 0.5) / (none0 + none1 + 10.0)
    own = T.LabelModel((n1 + 1) / (n0 + n1 + 2), (f1 + 0.5) / (n1 + 1), (f0 + 0.5) / (n0 + 1), silent)
    share = model.share
    for _ in range(3):
        own.share = share
        p = own.posterior(fired)
        weight = min(1.0, (n0 + n1) / n)
        t, a, b = weight * p.sum(), weight * (p @ fired), weight * ((1 - p) @ fired)
        c = weight * (1 - p).sum()
        m = t + c + n0 + n1
        own = T.LabelModel((t + n1 + 1) / (m + 2), (a + f1 + 0.5) / (t + n1 + 1), (b + f0 + 0.5) / (m - t - n1 + 1), silent)
    own.share = share
    assert np.allclose(model.toxic, own.toxic) and np.allclose(model.clean, own.clean) and model.prior == pytest.approx(own.prior)
    rows = spark.createDataFrame([(h.tobytes(), int(v)) for h, v in zip(hits, y)], "hits binary, label int").repartition(5)
    w = T.fit_classifier(rows, width, model)
    x, target = T._inputs(hits), own.posterior(fired)
    assert (T.fit_classifier(rows.withColumn("label", Q.F.lit(None).cast("int")), width, model) == pytest.approx(w))  # labels are not read
    gradient = x.T @ (target - 1 / (1 + np.exp(-x @ w))) - np.append(np.full(x.shape[1] - 1, 1.0), 1e-6) * w
    assert np.abs(gradient).max() < 0.05 * n ** 0.5
