import random
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from stratamart.llm import components as G
from stratamart.llm import exact_dedup as E
from stratamart.llm import near_dedup as N


def brute(rows, words, percent=80):
    """doc position -> (set size, smallest id reachable), by comparing all that share a shingle."""
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i:i + words]) for i in range(len(w) - words + 1)} if len(w) >= words else ({tuple(w)} if w else set()))
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    where = defaultdict(list)
    for i, s in enumerate(sets):
        shared = Counter(j for x in s for j in where[x])
        for j, n in shared.items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                parent[root(i)] = root(j)
        for x in s:
            where[x].append(i)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return [(d, len(sets[i]), least.get(root(i)) if sets[i] else d) for i, (d, _) in enumerate(rows)]


def result(df):
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in df.collect()), key=str)


@pytest.mark.parametrize("words", [2, 5])
def test_given_documents(spark, small_docs, words):
    df = spark.createDataFrame(small_docs, "doc_id long, text string")
    assert result(N.near_duplicates(df, words)) == sorted(brute(small_docs, words), key=str)


def test_chains_groups_and_links_away_from_the_pivot(spark):
    rnd = random.Random(2)
    base = [f"w{i}" for i in range(60)]
    rows, n = [], 0
    for start in range(12):  # a chain: neighbours are alike, ends are not
        rows.append((n, " ".join(base[start:start + 45])))
        n += 1
    for _ in range(300):  # one large group of near copies, each with a word of its own
        w = [f"v{i}" for i in range(80)]
        w[rnd.randrange(80)] = f"own{n}"
        rows.append((n, " ".join(w)))
        n += 1
    for _ in range(200):  # a common passage in texts of their own
        rows.append((n, " ".join([f"p{i}" for i in range(30)] + [f"x{rnd.randrange(10**6)}" for _ in range(40)])))
        n += 1
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert result(N.near_duplicates(df, 2)) == sorted(brute(rows, 2), key=str)


def test_messy_and_empty(messy, messy_rows, empty):
    rows = [(r[0], r[1]) for r in messy_rows]
    assert result(N.near_duplicates(messy, 2)) == sorted(brute(rows, 2), key=str)
    stay = N.drop_near_duplicates(messy, 2)
    assert stay.columns == messy.columns and {r["doc_id"] for r in stay.collect()} >= {None, 1, 5, 6, 7}
    assert N.near_duplicates(empty, 2).count() == 0


def test_rows_with_shared_or_missing_ids_are_told_apart(spark):
    words = [f"w{i}" for i in range(60)]
    text, near, other = " ".join(words), " ".join(words[:59]), "quite another text with more than five words"
    rows = [(5, near), (5, other), (3, text), (None, near), (None, text), (None, "a lone text that nobody else has written")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = [(3, text), (5, other), (None, rows[-1][1])]
    assert sorted(map(tuple, N.drop_near_duplicates(df).collect()), key=str) == sorted(want, key=str)


@pytest.mark.parametrize("held", [1, 2, 1000])
def test_a_batch_may_end_with_a_full_chunk(monkeypatch, held):
    monkeypatch.setattr(N, "ELEMENTS", held)
    batches = [pa.RecordBatch.from_arrays([pa.array(range(n), pa.int64()), pa.array([b"a b c", b"", b"d e f g"][:n], pa.binary()),
                                                pa.array(range(n), pa.int64())], names=["doc_id", "text", "mark"])
               for n in (3, 1, 0)]
    rows = [(r["doc_id"], r["n"]) for b in N._sign(2)(iter(batches)) for r in b.to_pylist()]
    assert rows == [(0, 2), (1, 0), (2, 3), (0, 2)]


@pytest.mark.parametrize("large", [0, 300])
def test_cells_are_bounded_and_hold_every_pair_once(spark, monkeypatch, large):
    monkeypatch.setattr(N, "PART", 40)
    monkeypatch.setattr(N, "CHUNK", 60)
    rnd = random.Random(large)
    rows = [(32 * b + 7, 1000 * b + i, int(10 * 1.3 ** rnd.uniform(0, 9))) for b, size in ((1, 700), (2, 50), (3, 1)) for i in range(size)]
    members = spark.createDataFrame(rows, "band long, node long, n long").repartition(4)
    labels = spark.createDataFrame([(i, 1000) for b, i, _ in rows if i < 1000 + large], "node long, component long")
    classes = members.select("node", "n", F.lit(b"s").alias("signature"))
    cells = defaultdict(list)
    for r in N._cells(members, labels, classes, 80).collect():
        cells[tuple(r[c] for c in N._CELL)].append(r)
    assert max(len(c) for c in cells.values()) <= 2 * 2 * 40
    pairs = Counter()
    for (band, low, high, apart, i, j), c in cells.items():
        inside = low == high and i == j and not apart
        probes, base = [r for r in c if (r["probe"] if inside else not r["base"])], c if inside else [r for r in c if r["base"]]
        pairs.update({(band, *sorted((x["node"], y["node"]))) for x in probes for y in base if x["component"] != y["component"]})
    comp = {i: 1000 if i < 1000 + large else i for _, i, _ in rows}
    want = {(x[0], *sorted((x[1], y[1]))) for x in rows for y in rows
            if x[0] == y[0] and comp[x[1]] != comp[y[1]] and 100 * min(x[2], y[2]) >= 80 * max(x[2], y[2])}
    assert want <= set(pairs) and set(pairs.values()) == {1}


def test_large_buckets_in_small_cells_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(N, "PART", 5)
    monkeypatch.setattr(N, "CHUNK", 4)
    rnd = random.Random(3)
    rows = [(n, " ".join([f"p{i}" for i in range(60)] + [f"x{rnd.randrange(4)}_{k}" for k in range(rnd.randint(6, 30))])) for n in range(160)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert result(N.near_duplicates(df, 2)) == sorted(brute(rows, 2), key=str)


def test_signature_estimates_similarity():
    rng = np.random.default_rng(1)
    errors = []
    for _ in range(100):
        u = rng.integers(0, 2**63, 300).astype(np.uint64)
        a, b = u[:270], np.concatenate([u[:240], u[270:]])
        s = N.superminhash(np.concatenate([a, b]), np.repeat([0, 1], [270, 270]), 2)
        errors.append((s[0] == s[1]).mean() - 0.8)
    assert abs(np.mean(errors)) < 0.01 and np.std(errors) < 0.036


def test_components(spark):
    rnd = random.Random(4)
    links = [(i, i - 1) for i in range(1, 200)] + [(1000, i) for i in range(1001, 1400)] + [(rnd.randrange(2000, 2100), rnd.randrange(2000, 2100)) for _ in range(60)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    df = spark.createDataFrame(links, "u long, v long").repartition(6)
    got = {r["node"]: r["component"] for r in G.components(df).collect()}
    assert got == {x: root(x) for x in {y for a, b in links if a != b for y in (a, b)}}
    assert G.components(df.filter("u < 0")).count() == 0


@pytest.mark.parametrize("step", ["sets", "confirm", "digests"])
def test_a_task_holds_few_rows_of_a_batch_at_a_time(step):
    """An Arrow batch has thousands of whole texts or sets: no step may copy all of them into Python objects."""
    rnd = random.Random(7)
    texts = [" ".join(f"w{rnd.randrange(10**6)}" for _ in range(200)).encode() for _ in range(3000)]
    sets = [N.hashed(N.shingle_set(t, 5)).tobytes() for t in texts]
    digests = [np.frombuffer(xxhash.xxh3_128_digest(x), np.int64) for x in sets]
    ids = pa.array(range(len(texts)), pa.int64())
    k1, k2 = (pa.array([int(d[i]) for d in digests], pa.int64()) for i in range(2))
    make, columns = {"sets": (N._sets(5), {"node": ids, "k1": k1, "k2": k2, "text": pa.array(texts, pa.binary())}),
                     "confirm": (N._confirm(80), {"u": ids, "v": ids, "x": pa.array(sets, pa.binary()), "y": pa.array(sets, pa.binary())}),
                     "digests": (E._digests, {"doc_id": ids, "text": pa.array(texts, pa.binary()), "mark": ids})}[step]
    batch = pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))
    del texts, sets, digests
    tracemalloc.start()
    rows = sum(b.num_rows for b in make(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == 3000 and peak < batch.nbytes / 2
