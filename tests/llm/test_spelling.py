"""Spelling variants against a one-process version of the definition."""

import re
import zlib
from collections import Counter

import pytest
from stratamart.llm import spelling
from stratamart.llm.pieces import pieces

RUN = re.compile(r"[A-Za-zÀ-ÿ]+")


def lower(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text)


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(rows, least=5, noise=199, ratio=5):
    n = Counter()
    for doc_id, text in rows:
        for run in RUN.findall(text or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % noise == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    n = {w: k for w, k in n.items() if len(w) >= 6 and k >= least}
    left = {}
    for w in n:
        for i in range(len(w)):
            left.setdefault(w[:i] + w[i + 1:], set()).add(w)
    out = {}
    for w in n:
        same = {x for i in range(len(w)) for x in left[w[:i] + w[i + 1:]]} | left.get(w, set())
        same |= {w[:i] + w[i + 1:] for i in range(len(w)) if w[:i] + w[i + 1:] in n}
        same = [x for x in same if near(w, x)]
        best = min(same, key=lambda x: (-n[x], x), default=None)
        out[w] = (best if best is not None and n[best] >= ratio * n[w] else None, len(same))
    rows = []
    for w, (form, k) in out.items():
        root = w
        while out[root][0] is not None:
            root = out[root][0]
        rows.append((w, form, root, n[w], k, None if form is None else n[form]))
    return sorted(rows, key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()), key=str)


def test_whole_table(spark, sf_dir, small_docs):
    got = rows_of(spelling.spelling_variants(spark.read.parquet(f"{sf_dir}/documents.parquet")))
    assert got == brute(small_docs) and any(r[1] for r in got)


@pytest.mark.parametrize("parts", [(1, 4), (3, 1), (2, 3)])
@pytest.mark.parametrize("bucket", [1, 64])
def test_links_are_whole(spark, parts, bucket):
    stem = "abcdef"
    words = {stem, "abcdefg", "zzzzzz", "zzzzzzz", "fedcba", "éàüößñ", "éàüößn"}
    words |= {stem[:i] + c + stem[i:] for i in range(7) for c in "aqé"} | {stem[:i] + c + stem[i + 1:] for i in range(6) for c in "aqé"}
    words = sorted(words)
    df = spark.createDataFrame([(w,) for w in words], "word string")
    got = {tuple(r) for r in spelling.near_words(df, *parts, bucket).collect()}
    assert got == {(a, b) for a in words for b in words if a != b and near(a, b)}


def test_parts_must_cover_the_distance():
    assert len(spelling.signature_subsets(1, 4)) == 6 and len(spelling.signature_subsets(3, 1)) == 3
    with pytest.raises(ValueError):
        spelling.signature_subsets(1, 1)


def test_roots_follow_forms(spark):
    forms = spark.createDataFrame([(f"w{i}", f"w{i + 1}") for i in range(9)], "word string, form string")
    assert {r["root"] for r in spelling.follow(forms).collect()} == {"w9"}


def test_messy(spark, messy, messy_rows, empty):
    got = rows_of(spelling.spelling_variants(messy, least=1))
    assert got == brute([r[:2] for r in messy_rows], least=1)
    assert spelling.spelling_variants(empty).count() == 0


def test_pieces_keep_words():
    raw = ("wörter und noch " * 50 + "x" * 40).encode()
    for size in (1, 7, 100, 10_000):
        parts = list(pieces(raw, size))
        assert b"".join(parts) == raw and [w for p in parts for w in p.split()] == raw.split()
    assert list(pieces(b"")) == [b""]
    text = ("Streets streets, streetss " * 40).encode()
    assert spelling.noisy_words(3, text) == spelling.noisy_words(3, text) and b"streets" in spelling.noisy_words(3, text, noise=10**12)
