import math
import random
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pytest

from stratamart.llm import lm_score as M


def reference(rows, order, strength=M.STRENGTH):
    """Scores straight from the recursive definition."""
    held = lambda i: zlib.crc32((str(i) if i is not None else "").encode()) % 5 == 1
    texts = [["<s>", *(t or "").encode().lower().split(), "</s>"] for _, t in rows]
    count = [Counter() for _ in range(order)]
    for (i, _), t in zip(rows, texts):
        if not held(i):
            for end in range(len(t)):
                for k in range(min(order, end + 1)):
                    count[k][tuple(t[end - k:end + 1])] += 1
    seen = {g: c for g, c in count[0].items() if g != ("<s>",)}
    n, v = sum(seen.values()), len(seen)
    root = lambda w: (count[0][(w,)] + 0.5) / (n + 0.5 * (v + 1))

    def p(w, h):
        if not h:
            return root(w)
        c = count[len(h) - 1][h]
        return (count[len(h)][(*h, w)] + strength * p(w, h[1:])) / (c + strength) if c else p(w, h[1:])

    return sorted(((i, held(i), len(t) - 1, sum(count[0][(w,)] > 0 for w in t[1:]), n, pytest.approx(sum(math.log10(root(w)) for w in t[1:])),
                    pytest.approx(sum(math.log10(p(t[k], tuple(t[max(0, k - order + 1):k]))) for k in range(1, len(t)))))
                   for (i, _), t in zip(rows, texts)), key=lambda r: (str(r[0]), r[2]))


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: (str(r[0]), r[2]))


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_against_the_definition(spark, monkeypatch, order):
    monkeypatch.setattr(M, "SLICE_TOKENS", 100)
    rnd = random.Random(order)
    rows = [(i, " ".join(rnd.choice(["a", "B", "cc", f"w{rnd.randrange(30)}", "é"]) for _ in range(rnd.choice([0, 1, 2, 9, 60])))) for i in range(80)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert result(M.lm_scores(df, order=order, block_bytes=500)) == reference(rows, order)


def test_messy_and_empty(messy, messy_rows, empty):
    assert result(M.lm_scores(messy)) == reference([(r[0], r[1]) for r in messy_rows], M.ORDER)
    assert M.lm_scores(empty).count() == 0


def test_without_training_rows(spark):
    only = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 5 == 1)
    row = M.lm_scores(spark.createDataFrame([(only, "some words")], "doc_id long, text string")).collect()[0]
    assert (row["held_out"], row["n_tokens"], row["n_known"], row["train_tokens"]) == (True, 3, 0, 0)
    assert row["base_score"] == row["score"] == 0.0


def test_context_helps_on_held_out_texts(spark, small_docs):
    rows = M.lm_scores(spark.createDataFrame(small_docs, "doc_id long, text string")).filter("held_out").collect()
    assert sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows)


def test_packing():
    keys = np.sort(np.random.default_rng(0).integers(0, 2**64, 1000, dtype=np.uint64))
    assert (M.unpack_keys(M.pack_keys(keys)) == keys).all() and len(M.unpack_keys(M.pack_keys(keys[:0]))) == 0
    assert (M.unpack_counts(M.pack_counts(np.arange(9))) == np.arange(9)).all()
    assert len(M.pack_keys(keys)) < 8 * len(keys)


def walked(texts):
    grams = M.BlockGrams(texts, np.ones(len(texts), bool), M.ORDER)
    grams.counts[0][M.START] = grams.counts[0][M.END]
    return M.Automaton(grams, M.ORDER, M.STRENGTH, int(grams.counts[0].sum()), grams.n_words), grams


def test_memory_of_a_block_per_token():
    """Two tasks and the JVM share an executor: a block of a million tokens has to stay well below 300 MB."""
    rnd = random.Random(3)
    words = [f"w{i}" for i in range(20_000)]
    texts = [" ".join(rnd.choices(words, k=1000)).encode() for _ in range(200)]
    tracemalloc.start()
    automaton, grams = walked(texts)
    automaton.scores()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 200 * len(grams.tokens)


def test_a_text_cut_into_slices_has_the_same_score(monkeypatch):
    rnd = random.Random(4)
    texts = [" ".join(f"w{rnd.randrange(9)}" for _ in range(n)).encode() for n in (0, 1, 500, 500, 3, 0)]
    automaton, _ = walked(texts)
    whole = list(automaton.scores())
    for size in (1, 7, 100, 499):
        monkeypatch.setattr(M, "SLICE_TOKENS", size)
        assert list(automaton.scores()) == whole
