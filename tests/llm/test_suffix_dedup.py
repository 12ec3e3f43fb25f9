import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from stratamart.llm import suffix_dedup as S


def brute(rows, length):
    raw = [(t or "").encode() for _, t in rows]
    seen = Counter(t[i:i + length] for t in raw for i in range(len(t) - length + 1))
    out = []
    for (doc_id, _), t in zip(rows, raw):
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        kept = bytes(c for c, g in zip(t, gone) if not g)
        out.append((doc_id, len(t), sum(gone), sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone)), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def result(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()), key=str)


def invented(seed, alphabet):
    rnd = random.Random(seed)
    make = lambda n: "".join(rnd.choice(alphabet) for _ in range(n))
    base, rows = [make(rnd.randint(0, 300)) for _ in range(6)], []
    for i in range(60):
        b, kind = rnd.choice(base), i % 5
        if kind == 1 and b:
            b = list(b)
            for _ in range(3):
                b[rnd.randrange(len(b))] = rnd.choice(alphabet)
            b = "".join(b)
        elif kind == 2:
            b = make(40) + b[:rnd.randint(0, 60)] + make(30) + b[:25]
        elif kind == 3:
            b = rnd.choice(["", "a" * rnd.randint(0, 100), "ab" * rnd.randint(0, 80)])
        rows.append((i, b))
    return rows


@pytest.mark.parametrize("group", [1000, 2])
@pytest.mark.parametrize(("alphabet", "length", "piece"), [("ab", 20, 6), ("abcdé ", 12, 4)])
def test_against_brute_force(spark, monkeypatch, group, alphabet, length, piece):
    monkeypatch.setattr(S, "GROUP", group)
    rows = invented(group, alphabet)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert result(S.repeated_passages(df, length, piece)) == brute(rows, length)


def test_given_documents(spark, small_docs):
    df = spark.createDataFrame(small_docs, "doc_id long, text string")
    assert result(S.repeated_passages(df)) == brute(small_docs, 200)


def test_messy_and_empty(messy, messy_rows, empty):
    assert result(S.repeated_passages(messy)) == brute([(r[0], r[1]) for r in messy_rows], 200)
    assert S.repeated_passages(empty).count() == 0


def test_long_texts_are_cut_into_overlapping_segments(monkeypatch):
    rnd = random.Random(3)
    text = bytes(rnd.choice(b"abc ") for _ in range(5000))
    whole = sorted((p, h) for _, at, own in S.anchors_of([text], 50, 10) for p, h in zip(at.tolist(), own.tolist()))
    monkeypatch.setattr(S, "SEGMENT", 300)
    cut = {(p, h) for _, at, own in S.anchors_of([text], 50, 10) for p, h in zip(at.tolist(), own.tolist())}
    assert cut == set(whole)


@pytest.mark.parametrize("segment", [7, 60, 300])
def test_an_anchor_at_a_border_of_segments_is_told_once(monkeypatch, segment):
    rnd = random.Random(3)
    text = bytes(rnd.choice(b"abc ") for _ in range(5000))
    told = lambda: sorted((r, p, h) for r, at, own in S.anchors_of([text, b"x" * 70, text], 50, 10) for p, h in zip(at.tolist(), own.tolist()))
    whole = told()
    monkeypatch.setattr(S, "SEGMENT", segment)
    assert told() == whole


def test_texts_of_several_segments_lose_only_what_repeats(spark):
    rnd = random.Random(6)
    n = S.SEGMENT + 150
    text = rnd.randbytes(n + 300).hex()  # two borders, nothing repeats
    passage = text[n - 200:n + 100]
    df = spark.createDataFrame([(1, text), (2, "z" + passage + "z")], "doc_id long, text string")
    spans = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"]) for r in S.repeated_passages(df).collect()}
    assert spans == {1: (len(text), 300, 1), 2: (302, 300, 1)}
    kept = hashlib.sha256((text[:n - 200] + text[n + 100:]).encode()).hexdigest()
    assert {r["kept_sha256"] for r in S.repeated_passages(df.filter("doc_id = 1")).collect()} == {hashlib.sha256(text.encode()).hexdigest()}
    assert kept in {r["kept_sha256"] for r in S.repeated_passages(df).collect()}


def common(a, b):
    return next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


def test_aligned_suffix_arrays():
    rnd = random.Random(7)
    contexts = [bytes(rnd.choice(b"ab") for _ in range(rnd.randint(8, 30))) for _ in range(60)]
    lefts = np.array([rnd.randint(0, min(8, len(c) - 1)) for c in contexts])
    family = np.array([rnd.randrange(4) for _ in contexts])
    for d, order, shared in S.aligned_suffix_arrays(family, lefts, contexts):
        suffix = {i: (family[i], contexts[i][lefts[i] - d:]) for i in range(60) if lefts[i] >= d}
        assert sorted(order.tolist()) == sorted(suffix)
        rows = [suffix[i] for i in order.tolist()]
        assert rows == sorted(rows)
        assert shared.tolist() == [0] + [common(x[1], y[1]) if x[0] == y[0] else 0 for x, y in zip(rows, rows[1:])]
    assert d == lefts.max()


def test_common_prefix_intervals():
    rnd = random.Random(8)
    words = sorted(bytes(rnd.choice(b"ab") for _ in range(rnd.randint(1, 12))) for _ in range(80))
    shared = [common(a, b) for a, b in zip(words, words[1:])]
    got = set(S.common_prefix_intervals(np.array([0, *shared]), 3))
    want = set()
    for i in range(len(words)):
        for j in range(i + 1, len(words)):
            least = min(shared[i:j])
            if least >= 3 and (i == 0 or shared[i - 1] < least) and (j == len(words) - 1 or shared[j] < least):
                want.add((i, j, least))
    assert got == want


def test_maximal_repeats_have_all_occurrences_and_different_bytes_before():
    groups = list(S.maximal_repeats(np.zeros(4, np.int64), np.array([3, 3, 3, 3]), [b"xyzHELLOab", b"wyzHELLOcd", b"wyzHELLOce", b"qqqHELLOzz"], 5))
    assert {(tuple(sorted(own.tolist())), int(at[0]), n) for own, at, n in groups} == {((0, 1, 2), 1, 7), ((0, 1, 2, 3), 3, 5), ((1, 2), 0, 9)}


def test_range_minimum():
    rng = np.random.default_rng(0)
    v = rng.integers(0, 100, 200)
    first = rng.integers(0, 199, 300)
    end = first + 1 + rng.integers(0, 200, 300) % (200 - first)
    assert S._range_minimum(v, first, end).tolist() == [int(v[a:b].min()) for a, b in zip(first, end)]


def near_copies(seed, length, piece):
    """Contexts of a few anchors, many alike up to some byte on either side, so that repeat groups lie inside each other."""
    rnd = random.Random(seed)
    anchors, lefts, contexts = [], [], []
    for family in range(4):
        base = bytes(rnd.choice(b"abcd") for _ in range(2 * length - piece))
        for _ in range(50):
            c = bytearray(base)
            for at in rnd.sample(range(len(c)), rnd.randint(0, 2)):
                if not length - piece <= at < length:
                    c[at] = rnd.choice(b"xyz")
            left = rnd.choice([length - piece, rnd.randint(0, length - piece)])
            anchors.append(family)
            lefts.append(left)
            contexts.append(bytes(c[length - piece - left:rnd.choice([None, len(c) - 3])]))
    return np.array(anchors, np.int64), np.array(lefts), contexts


@pytest.mark.parametrize("seed", range(4))
def test_what_is_covered_is_the_union_of_all_maximal_repeats(seed):
    anchors, lefts, contexts = near_copies(seed, 20, 6)
    want = {}
    for own, starts, common in S.maximal_repeats(anchors, lefts, contexts, 20):
        for i, at in zip(own.tolist(), starts.tolist()):
            want.setdefault(i, set()).update(range(at, at + common))
    ahead, after = S.covered_by_repeats(anchors, lefts, contexts, 20)
    got = {i: set(range(int(lefts[i] - ahead[i]), int(lefts[i] + after[i]))) for i in np.flatnonzero(ahead >= 0).tolist()}
    assert got == want and 100 < len(got) < 200


def test_occurrences_of_nested_groups_are_not_listed(monkeypatch):
    import pyarrow as pa
    anchors, lefts, contexts = near_copies(5, 20, 6)
    n, merged, whole = len(contexts), [], S._merged
    monkeypatch.setattr(S, "_merged", lambda r, s, e: merged.append(len(r)) or whole(r, s, e))
    cells = lambda v, t: [t(x).tobytes() for x in v]
    table = pa.table({"anchor": anchors, "block": pa.array([0] * n, pa.int32()), "refs": cells(range(n), np.int32),
                      "starts": cells(lefts, np.int64), "left": pa.array(lefts, pa.int32()), "context": contexts})
    out = S._intervals(20)(None, table)
    listed = sum(len(own) for own, _, _ in S.maximal_repeats(anchors, lefts, contexts, 20))
    assert out.num_rows == 1 and sum(merged) <= n < listed / 5


def test_windows_of_a_hot_anchor_are_hashed_some_contexts_at_a_time(monkeypatch):
    import pyarrow as pa
    rnd = random.Random(4)
    line = "the same line everywhere"
    rows = [(i, "".join(rnd.choice("abcdef") for _ in range(30)) + line + "".join(rnd.choice("abcdef") for _ in range(30))) for i in range(200)]
    texts = pa.table({"doc_id": [r[0] for r in rows], "text": [r[1].encode() for r in rows]})
    places = {t: t.index(line) for _, t in rows}
    again = S.window_keys(S.piece_hashes(np.frombuffer(line[:6].encode(), np.uint8), 6), np.array([0]), [line.encode()], len(line))[2]
    found = pa.table({"kind": ["place", "again"], "refs": [np.arange(200, dtype=np.int32).tobytes(), None],
                      "starts": [np.array([places[t] for _, t in rows]).tobytes(), None], "ends": pa.nulls(2, pa.binary()),
                      "keys": pa.array([None, again.tobytes()], pa.binary())})
    hashed, piece_hashes = [], S.piece_hashes
    monkeypatch.setattr(S, "piece_hashes", lambda data, size: hashed.append(len(data)) or piece_hashes(data, size))
    out = S._remove(len(line), 6)(texts, found)
    assert out.column("n_removed").to_pylist() == [len(line)] * 200
    assert len(hashed) < 10
