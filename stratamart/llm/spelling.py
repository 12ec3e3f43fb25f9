"""Spelling variants: words one edit apart, found by PartEnum signatures of their letter multisets.

A word's letters are a binary vector with one dimension per (letter, how often it
came before). One inserted, deleted or replaced letter changes at most two
dimensions. Dimensions are dealt by a fixed hash over ``first * second`` parts.
If two vectors differ in at most two places, some first-level part holds at most
``2 // first`` of them, so they agree on all but that many of its second-level
parts: every word emits one signature per way to leave that many out, and near words
share a signature exactly. Words join on equal signatures and are verified.

Syllable languages are full of anagrams, so a signature alone would gather thousands
of words that are not near. One edit leaves the first or the second half of the
letters as they are: the join key is the signature with either half, for words of
lengths S and S + 1. A bucket larger than ``BUCKET`` words is not compared in
pairs: its words are dealt once more by what is left of them without one letter,
which no more than an alphabet of words can share. Every link is found either way.

Texts are counted once per task and the counts summed, so a word that makes up a
third of all text is one row per task. Forms point at words at least ``RATIO`` times as
frequent, so chains are short; roots come by doubling the pointers.
"""

from __future__ import annotations

import itertools
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import doc_bytes, mix64, stored
from .pieces import pieces

LEAST_LETTERS, LEAST_COUNT, RATIO = 6, 5, 5
NOISE = 199
FIRST, SECOND = 1, 4
BUCKET = 64
HELD = 300_000

# Runs of [A-Za-zÀ-ÿ] in Latin-1: letters stay, A-Z lower-cased, all else is a space.
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 0xC0 else 32 for b in range(256))
_COUNTS = "word string, n long"
_KEYS = "key long, longer boolean, word string"
_FOUND = "a string, b string"


def noisy_words(doc_id: int | None, text: bytes, noise: int = NOISE) -> Counter:
    """The lower-cased letter runs of one text as Latin-1 bytes, some of them with a letter deleted."""
    found: Counter = Counter()
    for piece in pieces(text):
        found.update(w for w in piece.decode("utf-8", "replace").encode("latin-1", "replace").translate(_LETTERS).split()
                     if len(w) >= LEAST_LETTERS)
    start, out = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode()), Counter()
    for word, n in found.items():
        h = zlib.crc32(word if word.isascii() else word.decode("latin-1").encode(), start)
        if h % noise == 0:
            at = h % len(word)
            word = word[:at] + word[at + 1:]
            if len(word) < LEAST_LETTERS:
                continue
        out[word] += n
    return out


def _count(held: int):
    def batch(total):
        return pa.RecordBatch.from_arrays([pa.array([w.decode("latin-1") for w in total], pa.string()),
                                           pa.array(list(total.values()), pa.int64())], names=["word", "n"])

    def run(batches):
        total: dict[bytes, int] = {}
        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1)):
                for word, n in noisy_words(doc_id, text.as_py()).items():
                    total[word] = total.get(word, 0) + n
                if len(total) > held:
                    yield batch(total)
                    total = {}
        yield batch(total)
    return run


def word_counts(docs: DataFrame, least: int = LEAST_COUNT, held: int = HELD) -> DataFrame:
    """Words with at least ``least`` occurrences over all texts: word, n."""
    return (doc_bytes(docs).mapInArrow(_count(held), _COUNTS).groupBy("word").agg(F.sum("n").alias("n"))
            .filter(F.col("n") >= least))


def signature_subsets(first: int = FIRST, second: int = SECOND, distance: int = 2) -> list[tuple[int, ...]]:
    """The part numbers that each signature covers."""
    left_out = min(distance // first, second - 1)
    if first * (left_out + 1) <= distance:
        raise ValueError("these parts cannot cover the distance")
    return [tuple(i * second + j for j in kept) for i in range(first)
            for kept in itertools.combinations(range(second), second - left_out)]


def bucket_keys(words: list[str], first: int = FIRST, second: int = SECOND) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, longer, index of the word) of every bucket a word belongs to, as arrays."""
    raw = "".join(words).encode("latin-1")
    letter = np.frombuffer(raw, np.uint8).astype(np.uint64)
    size = np.array([len(w) for w in words], np.int64)
    start = np.concatenate(([0], np.cumsum(size)[:-1]))
    owner = np.repeat(np.arange(len(words)), size)
    at = np.arange(len(letter)) - start[owner]

    order = np.lexsort((letter, owner))  # how often the same letter came before, per word
    run = np.ones(len(order), bool)
    run[1:] = (letter[order][1:] != letter[order][:-1]) | (owner[order][1:] != owner[order][:-1])
    place = np.arange(len(order))
    before = np.empty(len(order), np.int64)
    before[order] = place - np.maximum.accumulate(np.where(run, place, 0))

    with np.errstate(over="ignore"):
        dim = mix64(letter + np.uint64(256) * (before.astype(np.uint64) + np.uint64(1)))
        parts = first * second
        cell = np.zeros((len(words), parts), np.uint64)
        np.add.at(cell, (owner, (dim % np.uint64(parts)).astype(np.int64)), mix64(dim + np.uint64(7)))
        cell = mix64(cell + np.arange(1, parts + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        signature = [mix64(cell[:, list(s)].sum(axis=1, dtype=np.uint64) + np.uint64(k + 1))
                     for k, s in enumerate(signature_subsets(first, second))]

        def sums(place):
            one = mix64(letter * np.uint64(1 << 20) + place.astype(np.uint64) + np.uint64(3))
            return np.concatenate((np.zeros(1, np.uint64), np.cumsum(one, dtype=np.uint64)))
        ahead, back = sums(at), sums(size[owner] - 1 - at)
        end = start + size
        keys, longer = [], []
        for less in (0, 1):  # as one of the S letters, and as one of the S + 1
            s = size - less
            half = s // 2
            for side, h in enumerate((ahead[start + half] - ahead[start], back[end] - back[end - (s - half)])):
                tag = mix64(h + s.astype(np.uint64) * np.uint64(2) + np.uint64(side))
                for g in signature:
                    keys.append(mix64(g ^ tag))
                    longer.append(np.full(len(words), bool(less)))
    index = np.tile(np.arange(len(words)), len(keys))
    return np.concatenate(keys).view(np.int64), np.concatenate(longer), index


def _emit_keys(first: int, second: int):
    def run(batches):
        for b in batches:
            if b.num_rows:
                key, longer, index = bucket_keys(b.column(0).to_pylist(), first, second)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(longer), b.column(0).take(pa.array(index))],
                                                 names=["key", "longer", "word"])
    return run


def one_edit(a: str, b: str) -> bool:
    """Whether exactly one insertion, deletion or replacement turns ``a`` into ``b``."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + 1:] == b[i + 1:] if len(a) == len(b) else a[i:] == b[i + 1:]


def _links(a, b):
    return pa.RecordBatch.from_arrays([pa.array(a, pa.string()), pa.array(b, pa.string())], names=["a", "b"])


def _compare(bucket: int):
    """Sorted (key, longer, word) rows to links (a, b); words of a bucket that outgrows ``bucket`` come out as (word, null)."""
    def run(batches):
        a, b = [], []
        key, short, long, full = None, [], [], False

        def close():
            for i, x in enumerate(short):
                for y in itertools.chain(short[i + 1:], long):
                    if one_edit(x, y):
                        a.append(x)
                        b.append(y)

        for rows in batches:
            keys = rows.column(0).to_numpy()
            edge = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.array([], np.int64)
            stop = np.append(edge[1:], len(keys))
            single = (stop - edge == 1) & (edge > 0) & (stop < len(keys))
            if key is not None and len(edge) and keys[0] != key:
                if not full:
                    close()
                short, long, full = [], [], False
            for s, e in zip(edge[~single].tolist(), stop[~single].tolist()):
                if keys[s] != key:
                    if key is not None and not full:
                        close()
                    key, short, long, full = keys[s], [], [], False
                found = rows.slice(s, e - s)
                for is_long, word in zip(found.column(1).to_pylist(), found.column(2).to_pylist()):
                    if full:
                        a.append(word)
                        b.append(None)
                        continue
                    (long if is_long else short).append(word)
                    if len(short) + len(long) > bucket:
                        a += short + long
                        b += [None] * (len(short) + len(long))
                        short, long, full = [], [], True
            if len(a) > 20_000:
                yield _links(a, b)
                a.clear()
                b.clear()
        if key is not None and not full:
            close()
        yield _links(a, b)
    return run


def _emit_rest(batches):
    """What is left of a word without one letter: with the place for replaced letters, without it for inserted ones."""
    for rows in batches:
        key, longer, index = [], [], []
        for k, w in enumerate(rows.column(0).to_pylist()):
            left = {(w[:i] + w[i + 1:], i) for i in range(len(w))}
            for text, long in [(f"{i}:{x}", False) for x, i in left] + [(f"-:{x}", True) for x in {x for x, _ in left}] + [(f"-:{w}", False)]:
                key.append(text)
                longer.append(long)
                index.append(k)
        yield pa.RecordBatch.from_arrays([pa.array(key, pa.string()), pa.array(longer, pa.bool_()),
                                          rows.column(0).take(pa.array(index, pa.int64()))], names=["key", "longer", "word"])


def near_words(words: DataFrame, first: int = FIRST, second: int = SECOND, bucket: int = BUCKET) -> DataFrame:
    """Links (word, near), both ways, between words of ``words`` (word) exactly one edit apart."""
    keyed = words.select("word").mapInArrow(_emit_keys(first, second), _KEYS)
    found = stored(keyed.repartition("key").sortWithinPartitions("key", "word").mapInArrow(_compare(bucket), _FOUND), "spelling-links")
    crowded = found.filter("b is null").select(F.col("a").alias("word")).distinct()
    rest = crowded.mapInArrow(_emit_rest, "key string, longer boolean, word string").repartition("key", "longer")
    shorts, longs = rest.filter("not longer"), rest.filter("longer")
    inserted = shorts.filter("key like '-:%'").select("key", F.col("word").alias("a")).join(
        longs.select("key", F.col("word").alias("b")), "key").select("a", "b")
    replaced = shorts.filter("key not like '-:%'").select("key", F.col("word").alias("a")).join(
        shorts.select("key", F.col("word").alias("b")), "key").filter("a < b").select("a", "b")
    links = found.filter("b is not null").unionByName(inserted).unionByName(replaced)
    both = links.select(F.col("a").alias("word"), F.col("b").alias("near")).unionByName(
        links.select(F.col("b").alias("word"), F.col("a").alias("near")))
    return both.distinct()


def follow(forms: DataFrame) -> DataFrame:
    """(word, root): the last form reached from each word of ``forms`` (word, form), by doubling the pointers."""
    now = stored(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        ahead = now.select(F.col("word").alias("_w"), F.col("root").alias("_r"))
        after = stored(now.join(ahead, F.col("root") == F.col("_w"), "left")
                          .select("word", F.coalesce("_r", "root").alias("root"), F.col("_r").isNotNull().alias("moved")), "spelling-roots")
        if after.filter("moved").isEmpty():
            return after.select("word", "root")
        now = after.select("word", "root")


def spelling_variants(docs: DataFrame, least: int = LEAST_COUNT, ratio: int = RATIO, first: int = FIRST,
                      second: int = SECOND, bucket: int = BUCKET) -> DataFrame:
    """Per word: its form (the most frequent near word, if ``ratio`` times as frequent), root, n, n_near, form_n.

    Null texts have no words; a null id counts as empty text in the hash that
    deletes letters; rows that repeat count as often as they come. Of equally frequent near
    words the first in code-point order is the form. Texts are read in pieces, so their
    length does not matter. An empty table gives no rows; other columns are ignored.
    """
    words = stored(word_counts(docs, least), "spelling-words")
    near = near_words(words, first, second, bucket)
    counts = words.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    best = near.join(counts, "near").groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near"))).alias("best"))
    rows = stored(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(-F.col("best.less") >= ratio * F.col("n"), F.col("best.near")).alias("form"),
        F.when(-F.col("best.less") >= ratio * F.col("n"), -F.col("best.less")).alias("form_n")), "spelling-forms")
    roots = follow(rows.filter("form is not null"))
    return rows.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
