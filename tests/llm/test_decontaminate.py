import math
import random
from collections import Counter

import pyarrow as pa
import pytest

from stratamart.llm import decontaminate as D


def bm25(items):
    """item -> {term: impact}, as the definition reads."""
    tf = {i: Counter(D.words_of(f"{q} {a}")) for i, q, a in items}
    df = Counter(t for c in tf.values() for t in c)
    mean = sum(sum(c.values()) for c in tf.values()) / len(tf)
    out = {}
    for i, c in tf.items():
        size = sum(c.values())
        w = {t: math.log1p((len(tf) - df[t] + 0.5) / (df[t] + 0.5)) * n * 2.2 / (n + 1.2 * (0.25 + 0.75 * size / mean)) for t, n in c.items()}
        out[i] = {t: x / sum(w.values()) for t, x in w.items()}
    return out


def made_items(rnd, n=150):
    return [(i, " ".join(f"t{int(rnd.expovariate(0.05))}" for _ in range(rnd.randint(4, 25))) + "?", " ".join(f"t{rnd.randrange(400)}" for _ in range(rnd.randint(1, 9))))
            for i in range(n)]


@pytest.mark.parametrize("threshold", [0.1, 0.3, 0.6])
def test_wand_finds_all_above_the_threshold(threshold):
    rnd = random.Random(int(threshold * 10))
    items = made_items(rnd)
    impacts = bm25(items)
    index = D.Index(items, [(i, t, x) for i, w in impacts.items() for t, x in w.items()], block=4)
    for _ in range(150):
        words = {f"t{int(rnd.expovariate(0.03))}" for _ in range(40)}
        if rnd.random() < 0.5:
            words |= set(D.words_of(rnd.choice(items)[1]))
        want = {i: sum(w.get(t, 0) for t in words) for i, w in impacts.items()}
        want = {i: s for i, s in want.items() if s >= threshold}
        terms = [index.terms[w] for w in words if w in index.terms]
        got = dict(index.search(terms, threshold))
        assert {index.items[k]: pytest.approx(s) for k, s in got.items()} == want
        ranged = [x for r in range(D.RANGES) for x in index.search(terms, threshold, index.edges[r], index.edges[r + 1])]
        assert dict(ranged) == pytest.approx(got)


def test_bounds_let_no_passage_through_the_net():
    rnd = random.Random(9)
    items = made_items(rnd)
    impacts = bm25(items)
    index = D.Index(items, [(i, t, x) for i, w in impacts.items() for t, x in w.items()])
    texts = [[rnd.choice([f"t{int(rnd.expovariate(0.05))}", "other"]) for _ in range(rnd.choice([0, 1, 30, 33, 34, 35, 68, 200]))] for _ in range(60)]
    found = {(d, first) for d, first, *_ in D._candidates(index, texts, 0.4)}
    for d, words in enumerate(texts):
        for start in range(0, max(1, len(words) - index.longest), index.longest):
            terms = {w for w in words[start:start + 2 * index.longest]}
            if any(sum(w.get(t, 0) for t in terms) >= 0.4 for w in impacts.values()):
                assert (d, start) in found


def test_leaks_are_found_and_others_left_alone(spark, sf_dir):
    docs, items = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    texts = {r["item_id"]: " ".join(D.words_of(r["text"])) for r in items.collect()}
    want = {(r["doc_id"], i) for r in docs.collect() for i, t in texts.items() if f" {t} " in f" {' '.join(D.words_of(r['text']))} "}
    got = {(r["doc_id"], r["item_id"]) for r in D.contaminated(docs, items).collect()}
    assert want and got == want
    sharded = {(r["doc_id"], r["item_id"]) for r in D.contaminated(docs, items, shard_bytes=3000).collect()}
    assert sharded == want
    assert {r["doc_id"] for r in D.drop_contaminated(docs, items).collect()} == {r["doc_id"] for r in docs.collect()} - {d for d, _ in want}


def test_question_and_answer_must_both_be_there(spark):
    rnd = random.Random(1)
    q, a = (" ".join(f"w{rnd.randrange(10**6)}" for _ in range(n)) for n in (20, 20))
    items = spark.createDataFrame([(1, q, a), (2, None, None), (None, q, a), (3, "short", None)] + [(10 + i, *x[1:]) for i, x in enumerate(made_items(rnd, 40))],
                                  "item_id long, question string, answer string")
    filler = " ".join(f"f{i}" for i in range(300))
    docs = spark.createDataFrame([(1, f"{filler} {q} {filler} {a}", 0.1), (2, f"{filler} {q.upper()}, {a.replace(' ', '  ')}. {filler}", 0.2), (3, q, 0.3),
                                  (4, f"{a} {filler}", 0.4), (5, None, 0.5), (None, f"{q} {a}", 0.6)], "doc_id long, text string, score double")
    assert {(r["doc_id"], r["item_id"]) for r in D.contaminated(docs, items).filter("item_id < 3").collect()} == {(2, 1), (None, 1)}
    left = {r["doc_id"] for r in D.drop_contaminated(docs, items).collect()}
    assert left >= {1, 3, 4, 5} and None not in left


def test_items_that_share_an_id_and_rows_that_do(spark):
    rnd = random.Random(4)
    one, two = (" ".join(f"w{rnd.randrange(10**6)}" for _ in range(30)) for _ in range(2))
    items = spark.createDataFrame([(7, one), (7, two), (7, two)] + [(100 + i, f"{x[1]} {x[2]}") for i, x in enumerate(made_items(rnd, 40))], "item_id long, text string")
    docs = spark.createDataFrame([(1, f"before {one} after"), (2, f"x {two} y"), (2, "clean text of its own"), (None, two), (None, "clean")],
                                 "doc_id long, text string")
    assert sorted((r["doc_id"], r["item_id"]) for r in D.contaminated(docs, items).filter("doc_id > 0").collect()) == [(1, 7), (2, 7)]
    assert sorted(r["text"] for r in D.drop_contaminated(docs, items).collect()) == ["clean", "clean text of its own"]


@pytest.mark.parametrize("held", [3, 5, 6, 100])
def test_a_batch_may_end_with_a_full_chunk(monkeypatch, held):
    items = made_items(random.Random(3), 20)
    index = D.Index(items, [(i, t, x) for i, w in bm25(items).items() for t, x in w.items()])
    texts = ["one two three", " ".join(D.words_of(f"{items[4][1]} {items[4][2]}")), "", "four five six seven eight nine"]
    batches = [pa.RecordBatch.from_arrays([pa.array(range(n), pa.int64()), pa.array([t.encode() for t in texts[:n]], pa.binary())], names=["doc_id", "text"])
               for n in (4, 2, 0)]
    monkeypatch.setattr(D, "CHUNK_WORDS", held)
    found = [(r["doc_id"], r["item_id"]) for b in D._search(index, 0.9, 0.9)(iter(batches)) for r in b.to_pylist()]
    assert found.count((1, 4)) == 2


def test_messy_and_empty(spark, messy, empty, sf_dir):
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    assert D.contaminated(messy, items).count() == 0 and D.contaminated(empty, items).count() == 0
    assert D.contaminated(messy, items.filter("item_id < 0")).count() == 0
    assert D.drop_contaminated(messy, items).columns == messy.columns
