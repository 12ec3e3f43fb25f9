from __future__ import annotations

import random

import pytest

WORDS = "river stone cloud amber field lantern quiet copper window garden letter harbour silver meadow candle".split()


def prose(rnd: random.Random, n: int) -> str:
    return " ".join(rnd.choice(WORDS) + rnd.choice(["", "s", "ed", "ing"]) for _ in range(n))


@pytest.fixture(scope="session")
def messy_rows():
    """Nulls, empty and very long texts, ties, repeated rows, and columns named like the operators' own."""
    rnd = random.Random(5)
    long = prose(rnd, 30_000)
    a, b = prose(rnd, 120), prose(rnd, 90)
    near = a.split()
    near[60] = "changed"
    texts = [(1, a), (2, a.upper()), (3, " ".join(near)), (4, b), (4, b), (5, None), (6, ""), (7, " \n\t "), (8, "one"), (9, "One"),
             (10, "two words"), (None, a), (None, None), (11, long), (12, long + " end"), (13, "é" * 300), (14, "a" * 500),
             (15, b + "\n" + a), (16, "password = hunter22secret"), (17, "\x00\x01 odd \x7f")]
    return [(i, t, None if k % 5 == 0 else "en", None if k % 4 == 0 else f"s{k % 3}", len(t or ""), True, 0.5, 7, "x")
            for k, (i, t) in enumerate(texts)]


@pytest.fixture(scope="session")
def messy(spark, messy_rows):
    return spark.createDataFrame(messy_rows, "doc_id long, text string, lang string, source string, n_chars long, kept boolean, "
                                             "score double, block int, `row` string").repartition(3).cache()


@pytest.fixture(scope="session")
def empty(messy):
    return messy.filter("doc_id = -1")


@pytest.fixture(scope="session")
def small_docs(spark, sf_dir):
    return [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
