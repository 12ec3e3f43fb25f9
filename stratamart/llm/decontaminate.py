"""Benchmark decontamination: a BM25 inverted index of the test items, searched by block-max WAND.

Impacts are BM25 weights of a term in an item divided by the item's own score,
so one threshold holds for items of any length. Term statistics are Spark
aggregates over all items. The index is broadcast in shards of bounded size;
with more items than one shard holds, the documents are read once per shard.

Every text is cut into overlapping passages, twice as long as the longest item
and one such length apart, so any copy of an item lies whole in one of them.
Each passage is a query. Items are numbered by length, so a range of numbers
holds items with impacts of one size; with the largest impact of every term per
range, array operations bound the score of a passage in each range, and where
the bound misses the threshold WAND would find no pivot. The ranges left go
through block-max WAND. Retrieved items are verified on the word shingles of
question and answer.
"""

from __future__ import annotations

import bisect
import re
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import doc_bytes, slices, text_mark, without

K1, B = 1.2, 0.75
THRESHOLD = 0.7
OVERLAP = 0.5
SHINGLE = 5
POSTING_BLOCK = 16
RANGES = 32
CHUNK_WORDS = 100_000
SHARD_BYTES = 32_000_000

_WORD = re.compile(r"\w+")
_TERMS = "item_id long, term string, tf int, length int"
_HITS = ("doc_id long, item_id long, score double, question_overlap double, answer_overlap double, "
         "first_word long, n_passages long, mark long")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def question_and_answer(text: str) -> tuple[str, str]:
    """Split an undivided item behind its last question mark, or else in the middle of its words."""
    head, mark, tail = text.rpartition("?")
    if mark and words_of(head) and words_of(tail):
        return head + mark, tail
    parts = text.split()
    half = (len(parts) + 1) // 2
    return " ".join(parts[:half]), " ".join(parts[half:])


def divided(benchmark: DataFrame) -> DataFrame:
    """item_id, question, answer; items that come as one ``text`` are split."""
    if {"question", "answer"} <= set(benchmark.columns):
        return benchmark.select(F.col("item_id").cast("long"), F.coalesce("question", F.lit("")).alias("question"),
                                F.coalesce("answer", F.lit("")).alias("answer"))

    def split(batches):
        for b in batches:
            parts = [question_and_answer(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([p[0] for p in parts], pa.string()),
                                              pa.array([p[1] for p in parts], pa.string())], names=["item_id", "question", "answer"])
    return (benchmark.select(F.col("item_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
                     .mapInArrow(split, "item_id long, question string, answer string"))


def _terms(batches):
    for b in batches:
        out = []
        for item, q, a in zip(*(b.column(i).to_pylist() for i in range(3))):
            words = words_of(f"{q} {a}")
            out += [(item, w, words.count(w), len(words)) for w in dict.fromkeys(words)]
        yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], t) for i, t in enumerate(
            (pa.int64(), pa.string(), pa.int32(), pa.int32()))], names=["item_id", "term", "tf", "length"])


def impacts(items: DataFrame, k1: float = K1, b: float = B) -> DataFrame:
    """Rows (item_id, term, impact): BM25 of the term in the item over the item's score for itself."""
    terms = items.mapInArrow(_terms, _TERMS)
    n, mean = terms.select("item_id", "length").distinct().agg(F.count("*"), F.avg("length")).first()
    df = terms.groupBy("term").agg(F.count("*").alias("df"))
    idf = F.log1p((F.lit(n) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    norm = F.col("tf") + k1 * (1 - b + b * F.col("length") / F.lit(mean or 1.0))
    weight = idf * F.col("tf") * (k1 + 1) / norm
    scored = terms.join(df, "term").withColumn("weight", weight)
    return scored.withColumn("impact", F.col("weight") / F.sum("weight").over(Window.partitionBy("item_id"))).select("item_id", "term", "impact")


class Index:
    """Postings by term, with the largest impact of every block of postings and of every range of item numbers."""

    def __init__(self, items: list, postings: list, shingle: int = SHINGLE, block: int = POSTING_BLOCK):
        size = {i: len(words_of(q)) + len(words_of(a)) for i, q, a in items}
        self.items = sorted(size, key=lambda i: (size[i], i))
        number = {i: k for k, i in enumerate(self.items)}
        self.parts = {}
        self.longest = 1
        for item, q, a in items:
            qw, aw = words_of(q), words_of(a)
            self.longest = max(self.longest, len(qw) + len(aw))
            self.parts[number[item]] = (shingles(qw, shingle), shingles(aw, shingle))
        by_term: dict[str, list] = {}
        for item, term, impact in postings:
            by_term.setdefault(term, []).append((number[item], impact))
        self.terms = {t: k for k, t in enumerate(sorted(by_term))}
        self.lists, self.blocks = [], []
        for t in self.terms:
            own = sorted(by_term[t])
            self.lists.append(([x[0] for x in own], [x[1] for x in own]))
            self.blocks.append([(own[min(i + block, len(own)) - 1][0], max(x[1] for x in own[i:i + block]))
                                for i in range(0, len(own), block)])
        self.most = np.array([max(x[1]) for x in self.lists] + [0.0])
        self.edges = [len(self.items) * k // RANGES for k in range(RANGES + 1)]
        self.by_range = np.zeros((len(self.terms) + 1, RANGES), np.float32)
        for t, (own, weights) in enumerate(self.lists):
            for i, w in zip(own, weights):
                r = bisect.bisect_right(self.edges, i) - 1
                self.by_range[t, r] = max(self.by_range[t, r], w)
        self.block, self.shingle = block, shingle
        self.names: dict[int, int] = {}  # the ids to report, where items are numbered otherwise

    def search(self, terms: list[int], threshold: float, first: int = 0, end: int | None = None) -> list[tuple[int, float]]:
        """Block-max WAND: all items numbered from ``first`` to before ``end`` whose summed impacts over ``terms`` reach the threshold."""
        found = []
        end = len(self.items) if end is None else end
        starts = [(t, bisect.bisect_left(self.lists[t][0], first)) for t in terms]
        cursors = [[self.lists[t][0][at], at, t] for t, at in starts if at < len(self.lists[t][0])]
        while cursors:
            cursors.sort()
            bound, pivot = 0.0, None
            for k, c in enumerate(cursors):
                bound += self.most[c[2]]
                if bound >= threshold:
                    pivot = k
                    break
            if pivot is None or cursors[pivot][0] >= end:
                break
            item = cursors[pivot][0]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == item:
                pivot += 1
            ahead = cursors[:pivot + 1]
            near = [self._block(c[2], c[1], item) for c in ahead]
            if sum(x[1] for x in near) < threshold:
                # no item up to the nearest block border, or the next cursor, can reach it
                nearest = min([x[0] for x in near] + ([cursors[pivot + 1][0] - 1] if pivot + 1 < len(cursors) else []))
                target = max(nearest, item) + 1
            elif cursors[0][0] == item:
                score = sum(self.lists[c[2]][1][c[1]] for c in ahead)
                if score >= threshold:
                    found.append((item, score))
                target = item + 1
            else:
                target = item
            for c in ahead:
                if c[0] < target:
                    self._advance(c, target)
            cursors = [c for c in cursors if c[0] is not None]
        return found

    def _block(self, term: int, at: int, item: int) -> tuple[int, float]:
        blocks = self.blocks[term]
        for k in range(at // self.block, len(blocks)):
            if blocks[k][0] >= item:
                return blocks[k]
        return 2**62, 0.0

    def _advance(self, cursor: list, target: int) -> None:
        items, at, blocks = self.lists[cursor[2]][0], cursor[1], self.blocks[cursor[2]]
        k = at // self.block
        while k < len(blocks) and blocks[k][0] < target:
            k += 1
        at = max(at, k * self.block)
        while at < len(items) and items[at] < target:
            at += 1
        cursor[0], cursor[1] = (items[at], at) if at < len(items) else (None, at)


def shingles(words: list[str], n: int) -> set:
    """Distinct runs of n words; a shorter list is one run, an empty one has none."""
    if not words:
        return set()
    return set(zip(*(words[i:] for i in range(n)))) if len(words) >= n else {tuple(words)}


def overlap(part: set, words: list[str], n: int) -> float:
    """Share of the part's shingles found among the words; an empty part is found anywhere."""
    if not part:
        return 1.0
    size = len(next(iter(part)))
    return len(part & set(zip(*(words[i:] for i in range(size))))) / len(part)


def _bounds(index: Index, ids: np.ndarray, doc: np.ndarray, at: np.ndarray, first_block: np.ndarray, blocks: int) -> np.ndarray:
    """For each block of a text, the bound of the passage that begins with it, per range of items.

    A passage is a block of ``index.longest`` words and the next one. A word counts
    in a passage where it stands first: ``same`` is how far back it stood before.
    """
    step = index.longest
    order = np.lexsort((at, ids, doc))
    i, d, a = ids[order], doc[order], at[order]
    before = np.full(len(order), -1, np.int64)
    same = (i[1:] == i[:-1]) & (d[1:] == d[:-1])
    before[1:][same] = a[:-1][same]
    block = first_block[d] + a // step
    start = a // step * step
    out = np.zeros((blocks + 1, RANGES), np.float32)
    for shift in (0, 1):  # as part of the passage's own block, and of the block after it
        counts = (before < start - shift * step) & (start >= shift * step)
        into = block[counts] - shift
        by = np.argsort(into, kind="stable")
        if len(by):
            edges = np.flatnonzero(np.diff(into[by], prepend=-1))
            out[into[by][edges]] += np.add.reduceat(index.by_range[i[counts][by]], edges, axis=0)
    return out[:blocks]


def _candidates(index: Index, texts: list[list[str]], threshold: float):
    """(text number, first word, end, term numbers, ranges) of the passages that may hold an item."""
    sizes = np.array([len(w) for w in texts])
    ids = np.fromiter(map(index.terms.get, chain.from_iterable(texts), repeat(-1)), np.int32, int(sizes.sum()))
    doc = np.repeat(np.arange(len(texts)), sizes)
    starts = np.cumsum(sizes) - sizes
    at = np.arange(len(ids)) - np.repeat(starts, sizes)
    step = index.longest
    n_blocks = np.maximum(1, -(-sizes // step))
    first_block = np.cumsum(n_blocks) - n_blocks
    known = ids >= 0
    reach = _bounds(index, ids[known], doc[known], at[known], first_block, int(n_blocks.sum())) >= threshold - 1e-4
    for b in np.flatnonzero(reach.any(1)):
        d = int(np.searchsorted(first_block, b, "right") - 1)
        first = int((b - first_block[d]) * step)
        end = int(min(first + 2 * step, sizes[d]))
        terms = np.unique(ids[starts[d] + first:starts[d] + end])
        yield d, first, end, terms[terms >= 0].tolist(), np.flatnonzero(reach[b]).tolist()


def _search(index: Index, threshold: float, least: float):
    def hits(rows, texts):
        best: dict[tuple[int, int], list] = {}
        for d, start, end, terms, ranges in _candidates(index, texts, threshold):
            for r in ranges:
                for item, score in index.search(terms, threshold, index.edges[r], index.edges[r + 1]):
                    q, a = (overlap(p, texts[d][start:end], index.shingle) for p in index.parts[item])
                    if q >= least and a >= least:
                        seen = best.setdefault((d, index.names.get(index.items[item], index.items[item])), [score, q, a, start, 0])
                        seen[4] += 1
                        if (q + a, score) > (seen[1] + seen[2], seen[0]):
                            seen[:4] = [score, q, a, start]
        out = [(rows[d][0], i, *v, rows[d][1]) for (d, i), v in sorted(best.items())]
        return pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], t) for i, t in enumerate(
            (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.int64(), pa.int64(), pa.int64()))],
            names=["doc_id", "item_id", "score", "question_overlap", "answer_overlap", "first_word", "n_passages", "mark"])

    def run(batches):
        for b in batches:
            ids, texts, held = [], [], 0
            for part in slices(b):
                marks = part.column(2).to_pylist() if part.num_columns > 2 else [None] * part.num_rows
                for doc_id, raw, mark in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), marks):
                    ids.append((doc_id, mark))
                    texts.append(words_of(raw.decode("utf-8", "replace")))
                    held += len(texts[-1])
                    if held >= CHUNK_WORDS:
                        yield hits(ids, texts)
                        ids, texts, held = [], [], 0
            if ids:
                yield hits(ids, texts)
    return run


def contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, least: float = OVERLAP,
                 shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """One row per document and benchmark item found in it: doc_id, item_id, score, overlaps, place, passages.

    Null texts have no words and match nothing; an item without words is never
    found; a null id is carried along; a repeated document row is searched again
    and repeats its rows; items that share an id are searched each, and the best of them is
    reported. Of equal scores the first passage counts. Empty tables give no rows; extra
    columns are ignored. A text is searched whole by one task, whose memory grows with it.
    """
    return _hits_of(docs, benchmark, threshold, least, shard_bytes).drop("mark")


def _hits_of(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, least: float = OVERLAP,
             shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """``contaminated`` with the mark of each row's text."""
    spark = docs.sparkSession
    items = divided(benchmark).filter(F.col("item_id").isNotNull())
    named = items.distinct().withColumn("number", F.xxhash64("item_id", "question", "answer"))
    items = named.select(F.col("number").alias("item_id"), "question", "answer")
    size = items.agg(F.sum(F.octet_length("question") + F.octet_length("answer"))).first()[0] or 0
    shards = max(1, -(-size // shard_bytes))
    weights = impacts(items)
    texts, found = doc_bytes(docs, text_mark()), None
    for k in range(shards):
        own = F.pmod(F.xxhash64("item_id"), F.lit(shards)) == k
        part = [tuple(r) for r in items.filter(own).collect()]
        index = Index(part, [tuple(r) for r in weights.filter(own).collect()])
        index.names = {r["number"]: r["item_id"] for r in named.filter(F.pmod(F.xxhash64("number"), F.lit(shards)) == k).select("number", "item_id").collect()}
        shipped = spark.sparkContext.broadcast(index)
        hits = texts.mapInArrow(_shipped_search(shipped, threshold, least), _HITS)
        found = hits if found is None else found.unionByName(hits)
    return found


def _shipped_search(shipped, threshold, least):
    def run(batches):
        yield from _search(shipped.value, threshold, least)(batches)
    return run


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` in which no item is found, with all their columns; each row by its own text, whatever its id."""
    return without(docs, _hits_of(docs, benchmark))
