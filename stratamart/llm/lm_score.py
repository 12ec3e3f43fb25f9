"""Language-model scores by a weighted backoff automaton.

Model: n-gram counts over the training texts with Dirichlet smoothing. With c the
training count of a run of tokens and h' the context h without its first token,

    p(w | h) = (c(h w) + strength * p(w | h')) / (c(h) + strength),
    p(w)     = (c(w) + 0.5) / (N + 0.5 * (V + 1)),

which sums to one. Every seen run is an arc, and the failure arc of a context
weighs strength / (c(h) + strength). The states are the contexts seen in training; a
traversal from left to right carries the state, takes the arc of the next token,
or failure arcs until there is one, and adds up log10 weights.

No task holds the whole model. Texts are dealt into blocks of bounded size. A
block sends its different runs, as sorted 64-bit keys with training counts, to
buckets by key; a bucket adds them up over all blocks and answers with what each
count lacks, in the order it was sent, which packs to little. Words and pairs go first;
a longer run can only be in another block too if both runs of one token less that it
holds are, so of these only such go, in a round for each length. The block builds the part of
the automaton its own texts can reach and walks it. A run that fills a third of the corpus
is one entry per block.

64-bit keys: among 10^7 different runs two share a key with a probability of
3 in a million; totals and vocabulary size are counted on the words themselves.
"""

from __future__ import annotations

from collections import defaultdict
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import block_count, block_of, doc_bytes, id_remainder, mix64, partitions_of, slices

ORDER = 3
STRENGTH = 5.0
SLICE_TOKENS = 100_000
BLOCK_BYTES = 10_000_000
HELD_OUT, HELD_REMAINDER = 5, 1
START, END = 0, 1  # token numbers in every block; their keys are not hashes of words
_MARK_KEYS = np.array([0x5851F42D4C957F2D, 0x14057B7EF767814F], np.uint64)
_MULTIPLY = np.uint64(0xD6E8FEB86659FD93)

_GRAMS = "bucket int, block int, size int, keys binary, counts binary"
_TOTALS = "block int, bucket int, size int, more binary, shared binary"
_SCORES = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def pack_keys(keys: np.ndarray) -> bytes:
    """Sorted uint64 keys as byte planes of their differences, compressed: the high planes are nearly all zero."""
    steps = np.diff(keys, prepend=np.uint64(0))
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes())


def unpack_keys(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


def pack_counts(counts: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(counts.astype(np.uint64).view(np.uint8).reshape(-1, 8).T).tobytes())


def unpack_counts(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view(np.uint64).ravel().astype(np.int64)


def _numbered(code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A place of each different value, in order of the values, and the number of the value at each place."""
    by = np.argsort(code)
    ordered = code[by]
    new = np.ones(len(code), bool)
    np.not_equal(ordered[1:], ordered[:-1], out=new[1:])
    del ordered
    number = np.empty(len(code), np.int32)
    number[by] = np.cumsum(new, dtype=np.int32) - np.int32(1)
    return by[new], number


class BlockGrams:
    """The runs of up to ``order`` tokens in one block of texts, each numbered, with local training counts.

    ``at[k]`` numbers the run of k + 1 tokens that ends at each token (-1 at the
    start mark, or where the text is too short); ``prefix[k]`` and ``suffix[k]``
    give the runs of k tokens it begins and ends with. Numbers have 32 bits, as an
    Arrow batch has less than 2^31 bytes of text.
    """

    def __init__(self, texts: list[bytes], training: np.ndarray, order: int):
        vocabulary = defaultdict(count(2).__next__)  # word -> its number, by first place
        number = vocabulary.__getitem__
        words = [np.fromiter(map(number, w), np.int32, len(w)) for w in (t.lower().split() for t in texts)]
        self.sizes = np.array([len(w) + 2 for w in words], np.int64)  # with both marks
        self.ends = np.cumsum(self.sizes)
        self.tokens = np.full(int(self.sizes.sum()), END, np.int32)
        starts = self.ends - self.sizes
        self.tokens[starts] = START
        inside = np.ones(len(self.tokens), bool)
        inside[starts] = False
        inside[self.ends - 1] = False
        if words:
            self.tokens[inside] = np.concatenate(words)
        train = np.repeat(training, self.sizes)
        n_words = len(vocabulary) + 2
        del words, inside
        hashes = np.concatenate([_MARK_KEYS, np.fromiter(map(xxhash.xxh3_64_intdigest, vocabulary), np.uint64, len(vocabulary))])
        del vocabulary, number
        self.at, self.keys, self.counts, self.prefix, self.suffix = [self.tokens], [hashes], [], [None], [None]
        self.counts.append(np.bincount(self.tokens[train], minlength=n_words))
        self.n_words = n_words
        for _ in range(1, order):
            before, shorter = np.concatenate([np.array([-1], np.int32), self.at[-1][:-1]]), self.at[-1]
            fits = (before >= 0) & (self.tokens != START)
            code = before[fits].astype(np.int64)
            code *= n_words
            code += self.tokens[fits]
            first, numbers = _numbered(code)
            del code
            at = np.full(len(self.tokens), -1, np.int32)
            at[fits] = numbers
            self.counts.append(np.bincount(numbers[train[fits]], minlength=len(first)))
            del numbers
            where = np.flatnonzero(fits)[first]
            del first, fits
            self.prefix.append(before[where])
            self.suffix.append(shorter[where])
            del before
            with np.errstate(over="ignore"):
                keys = self.keys[-1][self.prefix[-1]]
                keys *= _MULTIPLY
                keys += hashes[self.tokens[where]]
            self.at.append(at)
            self.keys.append(mix64(keys))

    def by_bucket(self, size: int, buckets: int, elsewhere: list[np.ndarray]):
        """Numbers of the runs that are sent, in key order, and (bucket, first, end) of each bucket's share. No start mark.

        ``elsewhere`` tells of each shorter run whether other blocks have it too.
        """
        keys = self.keys[size]
        by = np.argsort(keys).astype(np.int32)
        if size == 0:
            by = by[by != START]
        elif size > 1:
            shorter = elsewhere[size - 1]
            by = by[(shorter[self.prefix[size]] & shorter[self.suffix[size]])[by]]
        bucket = keys[by]
        bucket >>= np.uint64(32)
        bucket *= np.uint64(buckets)
        bucket >>= np.uint64(32)
        edges = np.flatnonzero(np.diff(bucket, prepend=np.uint64(2**63))).tolist()
        return by, [(int(bucket[lo]), lo, hi) for lo, hi in zip(edges, [*edges[1:], len(by)])]


class Automaton:
    """States are runs of fewer than ``order`` tokens seen in training, numbered by length; state 0 is the empty run.

    ``weight[k]`` has the log10 weight of the arc that ends each run of k + 1 tokens.
    """

    def __init__(self, grams: BlockGrams, order: int, strength: float, tokens: int, types: int):
        c = grams.counts
        p = (c[0] + 0.5) / (tokens + 0.5 * (types + 1))
        self.weight = [np.log10(p)]
        # a start mark is a context once per training text
        for k in range(1, order):
            below, over = p[grams.suffix[k]], c[k - 1][grams.prefix[k]]
            p = np.where(over > 0, (c[k] + strength * below) / (over + strength), below)
            del below, over
            self.weight.append(np.log10(p))
        # number the states: the empty run, then the seen runs by length; first[k] is the first of k tokens
        self.first, self.state_of = [0, 1], []
        for k in range(order - 1):
            seen = c[k] > 0
            number = np.zeros(len(seen), np.int32)
            number[seen] = np.arange(self.first[-1], self.first[-1] + int(seen.sum()), dtype=np.int32)
            self.state_of.append(number)
            self.first.append(self.first[-1] + int(seen.sum()))
        self.fail, self.fail_weight = np.zeros(self.first[-1], np.int32), np.zeros(self.first[-1])
        for k in range(order - 1):
            seen = np.flatnonzero(self.state_of[k])
            own = self.state_of[k][seen]
            if k:
                self.fail[own] = self.state_of[k - 1][grams.suffix[k][seen]]
            self.fail_weight[own] = np.log10(strength / (c[k][seen] + strength))
        self.grams, self.order = grams, order

    def _states(self, first: int, end: int) -> np.ndarray:
        """The state after each token from ``first`` to ``end``: the longest run there that is one."""
        state = np.zeros(end - first, np.int32)
        for k, number in enumerate(self.state_of):
            run = self.grams.at[k][first:end]
            found = np.where(run >= 0, number[run], 0)
            np.copyto(state, found, where=found > 0)
        return state

    def _steps(self, first: int, end: int) -> np.ndarray:
        """The log10 weights that the traversal adds at each token: those of failure arcs, then that of the token's arc; 0 else.

        A state is the longest seen run before the token, so all tokens of a slice take their steps side by side.
        """
        g = self.grams
        state = self._states(max(first - 1, 0), end - 1)
        if first == 0:
            state = np.concatenate([np.zeros(1, np.int32), state])
        steps = np.zeros((end - first, self.order))
        moving = g.tokens[first:end] != START
        for k in range(self.order - 1, 0, -1):
            on = np.flatnonzero(moving & (state >= self.first[k]))  # in a state of k tokens
            run = g.at[k][first:end][on]
            arc = g.counts[k][run] > 0
            steps[on[arc], -1 - k] = self.weight[k][run[arc]]
            moving[on[arc]] = False
            on = on[~arc]
            steps[on, -1 - k] = self.fail_weight[state[on]]
            state[on] = self.fail[state[on]]
        on = np.flatnonzero(moving)
        steps[on, -1] = self.weight[0][g.tokens[first:end][on]]
        return steps

    def scores(self) -> np.ndarray:
        """log10 probability of each text of the block, added up from left to right, a slice of tokens at a time."""
        ends = self.grams.ends
        out = np.zeros(len(ends))
        for first in range(0, len(self.grams.tokens), SLICE_TOKENS):
            end = min(first + SLICE_TOKENS, len(self.grams.tokens))
            owner = np.searchsorted(ends, np.arange(first, end), "right")
            low = int(owner[0])
            weights = np.concatenate([out[low:low + 1], self._steps(first, end).ravel()])  # goes on from the slice before
            owner = np.concatenate([np.zeros(1, np.int64), np.repeat(owner - low, self.order)])
            added = np.bincount(owner, weights)
            out[low:low + len(added)] = added
        return out


def _ordered(table: pa.Table) -> pa.Table:
    return table.sort_by([("doc_id", "ascending")])


def _block_grams(table: pa.Table, order: int) -> BlockGrams:
    return BlockGrams(table.column("text").to_pylist(), ~np.array(table.column("held_out").to_pylist(), bool), order)


def _sent(grams: BlockGrams, block: int, sizes: range, buckets: int, elsewhere: list[np.ndarray]) -> pa.Table:
    rows = []
    for k in sizes:
        by, shares = grams.by_bucket(k, buckets, elsewhere)
        for bucket, lo, hi in shares:
            rows.append((bucket, block, k, pack_keys(grams.keys[k][by[lo:hi]]), pack_counts(grams.counts[k][by[lo:hi]])))
    return pa.table([pa.array([r[i] for r in rows], t) for i, t in enumerate(
        (pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary()))], names=["bucket", "block", "size", "keys", "counts"])


def _answered(grams: BlockGrams, totals: pa.Table, sizes: int, buckets: int) -> list[np.ndarray]:
    """Complete the counts of the runs of up to ``sizes`` tokens; per size, which runs other blocks have."""
    answers = {(z, b): (m, s) for z, b, m, s in zip(*(totals.column(c).to_pylist() for c in ("size", "bucket", "more", "shared")))}
    elsewhere: list[np.ndarray] = []
    for k in range(sizes):
        more, shared = np.zeros(len(grams.keys[k]), np.int64), np.zeros(len(grams.keys[k]), bool)
        by, shares = grams.by_bucket(k, buckets, elsewhere)
        for bucket, lo, hi in shares:
            if (k, bucket) in answers:
                lacking, bits = answers[k, bucket]
                if lacking is not None:
                    more[by[lo:hi]] = unpack_counts(lacking)
                shared[by[lo:hi]] = np.unpackbits(np.frombuffer(bits, np.uint8), count=hi - lo).astype(bool)
        if k == 0:
            shared[START] = True
        grams.counts[k] = grams.counts[k] + more
        elsewhere.append(shared)
    return elsewhere


def _send(order: int, buckets: int):
    def run(key, table):
        return _sent(_block_grams(table, min(order, 2)), key[0].as_py(), range(min(order, 2)), buckets, [])
    return run


def _send_longer(size: int, buckets: int):
    """The runs of ``size`` + 1 tokens, after the answers on all shorter ones."""
    def run(texts, totals):
        grams = _block_grams(_ordered(texts), size + 1)
        elsewhere = _answered(grams, totals, size, buckets)
        block = texts.column("block")[0].as_py() if texts.num_rows else 0
        return _sent(grams, block, range(size, size + 1) if texts.num_rows else range(0), buckets, elsewhere)
    return run


def _add(key, table):
    """What each block's counts of the bucket's keys lack to the totals, and which keys other blocks sent too, in the order sent."""
    out = []
    sizes = np.array(table.column("size").to_pylist())
    for size in np.unique(sizes):
        part = table.filter(pa.array(sizes == size))
        blocks = part.column("block").to_pylist()
        keys = [unpack_keys(x) for x in part.column("keys").to_pylist()]
        counts = [unpack_counts(x) for x in part.column("counts").to_pylist()]
        _, inverse, senders = np.unique(np.concatenate(keys), return_inverse=True, return_counts=True)
        totals, shared = np.bincount(inverse, weights=np.concatenate(counts)).astype(np.int64)[inverse], (senders > 1)[inverse]
        at = 0
        for block, local in zip(blocks, counts):
            more, common = totals[at:at + len(local)] - local, shared[at:at + len(local)]
            at += len(local)
            if common.any():
                out.append((block, key[0].as_py(), int(size), pack_counts(more) if more.any() else None, np.packbits(common).tobytes()))
    return pa.table([pa.array([r[i] for r in out], t) for i, t in enumerate(
        (pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary()))], names=["block", "bucket", "size", "more", "shared"])


def _walk(order: int, buckets: int, strength: float, tokens: int, types: int):
    def run(texts, totals):
        table = _ordered(texts)
        grams = _block_grams(table, order)
        _answered(grams, totals, order, buckets)
        grams.counts[0][START] = grams.counts[0][END]  # each training text begins once, as it ends once
        automaton = Automaton(grams, order, strength, tokens, types)
        starts = grams.ends - grams.sizes  # start marks are not tokens of the text
        scores = automaton.scores()
        base, known = automaton.weight[0][grams.tokens], (grams.counts[0] > 0)[grams.tokens].astype(np.int64)
        base[starts], known[starts] = 0.0, 0
        return pa.table([
            table.column("doc_id"), table.column("held_out"), pa.array(grams.sizes - 1, pa.int64()),
            pa.array(np.add.reduceat(known, starts), pa.int64()), pa.array([tokens] * len(starts), pa.int64()),
            pa.array(np.add.reduceat(base, starts), pa.float64()), pa.array(scores, pa.float64())],
            names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])
    return run


def _different_words(batches):
    """The different words of a batch, and in a row without a word how many words it has."""
    for b in batches:
        seen: set[bytes] = set()
        n = 0
        for part in slices(b):
            for text in part.column("text").to_pylist():
                words = text.lower().split()
                seen.update(words)
                n += len(words)
        yield pa.RecordBatch.from_arrays([pa.array([None, *seen], pa.binary()), pa.concat_arrays([pa.array([n], pa.int64()), pa.nulls(len(seen), pa.int64())])],
                                         names=["word", "n"])


def training_size(rows: DataFrame) -> tuple[int, int]:
    """Tokens and different tokens of the training rows (text), one end per text included."""
    words = rows.mapInArrow(_different_words, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    n, v = words.agg(F.sum("n"), F.count("word")).first()
    ends = rows.count()
    return (n or 0) + ends, v + (ends > 0)


def lm_scores(docs: DataFrame, order: int = ORDER, strength: float = STRENGTH, held_out: int = HELD_OUT,
              remainder: int = HELD_REMAINDER, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (both log10).

    Rows whose id remainder modulo ``held_out`` is ``remainder`` are scored but teach
    nothing. Null text is empty and is one end; a null id counts as empty text in the
    remainder; repeated rows count each; without training rows every token is unseen.
    Extra columns are ignored; an empty table gives no rows. Equal texts have equal
    scores; a block is at least one text, so a task's memory grows with the longest.
    """
    spark = docs.sparkSession
    blocks = block_count(docs, block_bytes=block_bytes)
    held = (id_remainder(held_out) == remainder).alias("held_out")
    rows = doc_bytes(docs, held).withColumn("block", block_of(blocks))
    tokens, types = training_size(rows.filter("NOT held_out").select("text"))
    dealt = rows.repartition(max(partitions_of(spark), 1), "block")
    totals = dealt.groupBy("block").applyInArrow(_send(order, blocks), _GRAMS).groupBy("bucket").applyInArrow(_add, _TOTALS)
    for size in range(2, order):
        longer = dealt.groupBy("block").cogroup(totals.groupBy("block")).applyInArrow(_send_longer(size, blocks), _GRAMS)
        totals = totals.unionByName(longer.groupBy("bucket").applyInArrow(_add, _TOTALS))
    return dealt.groupBy("block").cogroup(totals.groupBy("block")).applyInArrow(
        _walk(order, blocks, strength, tokens, types), _SCORES)
