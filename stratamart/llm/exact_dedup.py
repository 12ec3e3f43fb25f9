"""Exact duplicates: owners of equal texts from Patricia tries.

Texts are equal when their bytes are, after lower-casing A-Z. Rows are dealt to
partitions by (byte length, 64-bit content hash); each partition inserts the full
byte strings of all its texts into one compressed radix trie, whose terminal nodes carry
the owner (largest id, or smallest on demand) and the number of rows. A trie that
outgrows its budget writes its largest subtree to a task-local file and finishes
that subtree after the rest, so a partition of any size fits.

Each Arrow batch first merges its own copies, so of a text that makes up a third
of all rows one row per batch is shuffled, not one per document. Documents get
their owner back by a join on the text's digest, whose hot side adaptive
execution may split because the owner side has one row per text.
"""

from __future__ import annotations

import hashlib
import os
import pickle
import tempfile
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SLICE_ROWS, doc_bytes, slices, text_mark, without

TRIE_BYTES = 128_000_000
NODE_BYTES = 400  # what a node takes besides its edge


class Node:
    __slots__ = ("children", "edge", "value")

    def __init__(self, edge: bytes, value=None):
        self.edge, self.value, self.children = edge, value, {}


class PatriciaTrie:
    """Byte strings in a path-compressed radix trie; values of equal strings are merged.

    ``budget`` bounds the bytes held in edges and nodes. Beyond it, the heaviest child of the
    root is spilled: its strings, and later ones that start like it, go to a file.
    ``items`` yields the strings held, then those of each spilled subtree from a
    trie of its own, whose strings no longer repeat the shared prefix.
    """

    def __init__(self, merge, budget: int = TRIE_BYTES):
        self.root, self.merge, self.budget, self.held = Node(b""), merge, budget, 0
        self.weight: dict[int, int] = {}
        self.spilled: dict[int, object] = {}

    def insert(self, key: bytes, value) -> None:
        if key and key[0] in self.spilled:
            pickle.dump((key, value), self.spilled[key[0]])
            return
        before = self.held
        self._insert(key, value)
        if key:
            self.weight[key[0]] = self.weight.get(key[0], 0) + self.held - before
        if self.held > self.budget and len(self.weight) > 0 and not self._one_string():
            self._spill(max(self.weight, key=self.weight.get))

    def _insert(self, key: bytes, value) -> None:
        node, at = self.root, 0
        while True:
            if at == len(key):
                node.value = value if node.value is None else self.merge(node.value, value)
                return
            child = node.children.get(key[at])
            if child is None:
                node.children[key[at]] = Node(key[at:], value)
                self.held += len(key) - at + NODE_BYTES
                return
            edge = child.edge
            if key.startswith(edge, at):
                node, at = child, at + len(edge)
                continue
            same = len(os.path.commonprefix([edge, key[at:at + len(edge)]]))
            middle = Node(edge[:same])
            child.edge = edge[same:]
            middle.children[child.edge[0]] = child
            node.children[key[at]] = middle
            self.held += NODE_BYTES
            node, at = middle, at + same

    def _one_string(self) -> bool:
        node = self.root
        while len(node.children) == 1 and node.value is None:
            node = next(iter(node.children.values()))
        return not node.children

    def _spill(self, byte: int) -> None:
        out = tempfile.TemporaryFile()
        for key, value in _walk(self.root.children.pop(byte), b""):
            pickle.dump((key, value), out)
        self.held -= self.weight.pop(byte)
        self.spilled[byte] = out

    def items(self) -> Iterator[tuple[bytes, object]]:
        yield from _walk(self.root, b"")
        self.root, self.held = Node(b""), 0
        for out in self.spilled.values():
            yield from self._reload(out)

    def _reload(self, out) -> Iterator[tuple[bytes, object]]:
        prefix, deeper = None, PatriciaTrie(self.merge, self.budget)
        for key, _ in _records(out):
            prefix = key if prefix is None else os.path.commonprefix([prefix, key])
        for key, value in _records(out):
            deeper.insert(key[len(prefix):], value)
        for key, value in deeper.items():
            yield prefix + key, value
        out.close()


def _walk(node: Node, before: bytes) -> Iterator[tuple[bytes, object]]:
    stack = [(node, before)]
    while stack:
        node, before = stack.pop()
        key = before + node.edge
        if node.value is not None:
            yield key, node.value
        stack.extend((child, key) for child in node.children.values())


def _records(out) -> Iterator[tuple[bytes, object]]:
    out.seek(0)
    while True:
        try:
            yield pickle.load(out)
        except EOFError:
            return


def _merge_largest(a, b):
    ids = [x for x in (a[0], b[0]) if x is not None]
    return max(ids) if ids else None, a[1] + b[1]


def _merge_smallest(a, b):
    ids = [x for x in (a[0], b[0]) if x is not None]
    return min(ids) if ids else None, a[1] + b[1]


_TEXTS = "n long, h long, text binary, owner long, copies long"
_OWNERS = "digest binary, owner long, copies long"


def _texts_of_batch(merge):
    def run(batches):
        for b in batches:
            seen: dict[bytes, tuple] = {}
            for part in slices(b):
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    key = text.lower()
                    seen[key] = merge(seen[key], (doc_id, 1)) if key in seen else (doc_id, 1)
            every = iter(seen)
            while keys := list(islice(every, SLICE_ROWS)):
                yield pa.RecordBatch.from_arrays([
                    pa.array([len(k) for k in keys], pa.int64()),
                    pa.array([xxhash.xxh3_64_intdigest(k) - 2**63 for k in keys], pa.int64()),
                    pa.array(keys, pa.binary()), pa.array([seen[k][0] for k in keys], pa.int64()),
                    pa.array([seen[k][1] for k in keys], pa.int64())], names=["n", "h", "text", "owner", "copies"])
    return run


def _owners_of_partition(merge, budget):
    def batch(out):
        return pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.binary()), pa.array([x[1] for x in out], pa.int64()),
                                           pa.array([x[2] for x in out], pa.int64())], names=["digest", "owner", "copies"])

    def run(batches):
        trie, out = PatriciaTrie(merge, budget), []
        for b in batches:
            for text, owner, copies in zip(*(b.column(i) for i in range(3))):
                trie.insert(text.as_py(), (owner.as_py(), copies.as_py()))
        for text, (owner, copies) in trie.items():
            out.append((hashlib.sha256(text).digest(), owner, copies))
            if len(out) >= 5000:
                yield batch(out)
                out = []
        yield batch(out)
    return run


def _digests(batches):
    for b in batches:
        digests = [hashlib.sha256(t.lower()).digest() for part in slices(b) for t in part.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(digests, pa.binary()), b.column(2)], names=["doc_id", "text_digest", "mark"])


def text_owners(docs: DataFrame, keep: str = "largest", trie_bytes: int = TRIE_BYTES) -> DataFrame:
    """One row per different text: its ``digest``, the id that owns it and the number of rows that carry it."""
    merge = {"largest": _merge_largest, "smallest": _merge_smallest}[keep]
    texts = doc_bytes(docs).mapInArrow(_texts_of_batch(merge), _TEXTS)
    return texts.repartition("n", "h").select("text", "owner", "copies").mapInArrow(_owners_of_partition(merge, trie_bytes), _OWNERS)


def exact_duplicates(docs: DataFrame, keep: str = "largest", trie_bytes: int = TRIE_BYTES) -> DataFrame:
    """Per document: doc_id, keep_id, group_size, kept, text_sha256.

    Null text is empty text. A null id never owns a text that a row with an id
    carries; if no row has one, keep_id is null and these rows stay. Rows that
    repeat the owner's id are one document and stay together. An empty table gives
    no rows; other columns are ignored. Of equally long texts nothing is compared but
    whole bytes; a text is held whole, with its trie, by one task.
    """
    return _owned(docs, keep, trie_bytes).drop("mark")


def _owned(docs: DataFrame, keep: str = "largest", trie_bytes: int = TRIE_BYTES) -> DataFrame:
    """``exact_duplicates`` with the mark of each row's text."""
    rows = doc_bytes(docs, text_mark()).mapInArrow(_digests, "doc_id long, text_digest binary, mark long")
    owners = text_owners(docs, keep, trie_bytes)
    return rows.join(owners, rows["text_digest"] == owners["digest"]).select(
        "doc_id", F.col("owner").alias("keep_id"), F.col("copies").alias("group_size"),
        F.col("doc_id").eqNullSafe(F.col("owner")).alias("kept"), F.lower(F.hex("text_digest")).alias("text_sha256"), "mark")


def drop_exact_duplicates(docs: DataFrame, keep: str = "largest") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; each row by its own text, also where an id is missing or shared."""
    return without(docs, _owned(docs, keep).filter("NOT kept"))
