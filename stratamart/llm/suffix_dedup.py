"""Repeated passages: maximal repeats from the common-prefix intervals of enhanced suffix arrays.

A byte goes if a string of ``length`` bytes that covers it also starts anywhere else.

* Anchors. Of every window of ``length`` bytes the least hashed piece of PIECE
  bytes is its anchor. Equal windows have equal anchors at equal places, so a
  repeated window shows up as a repeated anchor, and the bytes around an anchor,
  its context, hold every window that has it. Blocks of texts send their
  different (anchor, context hash) pairs with counts, packed, to buckets by pair; a
  bucket sends how many different contexts it has of each anchor, which are added up
  by anchor. So an anchor in a third of all texts is one number per bucket.
* A context that occurs twice repeats as a whole. An anchor with one occurrence
  repeats nothing. Only anchors with several different contexts are open; of each
  of their contexts one copy goes on.
* Open contexts meet by anchor. Their suffixes are sorted for each distance from
  the anchor, the next distance by induced sorting from the last, and the longest
  common prefixes of neighbours are kept. The intervals of common prefixes of at
  least ``length`` in these enhanced suffix arrays, found for a whole array at once,
  whose occurrences have different bytes to the left are the maximal repeat groups.
  The union of their occurrences is what repeats. Groups lie inside each other, so a
  group is painted over its interval, the longest last, and not listed by member.
* An anchor with more than GROUP different contexts, such as a line in a third
  of all texts, is not gathered: its windows are counted by hash over all
  buckets, which finds the same intervals of common prefixes of ``length``.

Long texts are worked in segments; no task holds more than a block of texts or
one bucket.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import block_count, block_of, doc_bytes, mix64, partitions_of, stored

LENGTH = 200
PIECE = 48
SEGMENT = 1_000_000
CHUNK = 65_536
GROUP = 20_000
BATCH = 2_000_000
BLOCK = 8_000_000
COVERED, OPEN, HOT = 1, 2, 4

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_TOP = np.iinfo(np.uint64).max

_PAIRS = "bucket int, block int, anchors binary, contexts binary, counts binary"
_CONTEXTS = "owner int, bucket int, anchors binary, counts binary"
_OPENED = "bucket int, anchors binary, states binary"
_VERDICTS = "block int, anchors binary, contexts binary, verdicts binary"
_FOUND = ("kind string, bucket int, block int, refs binary, starts binary, ends binary, anchor long, context binary, "
          "left int, keys binary")
_RUNS = "block int, refs binary, starts binary, ends binary"
_ROWS = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _powers(n: int, base: np.uint64) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    with np.errstate(over="ignore"):
        return np.cumprod(out, dtype=np.uint64)


_cache: dict[str, np.ndarray] = {"up": np.zeros(0, np.uint64), "down": np.zeros(0, np.uint64)}


def piece_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` bytes from every position on; the last size - 1 positions have none."""
    n = len(data)
    if n < size:
        return np.zeros(0, np.uint64)
    if len(_cache["up"]) <= n:
        _cache["up"], _cache["down"] = _powers(2 * n + 1, _BASE), _powers(2 * n + 1, _INVERSE)
    with np.errstate(over="ignore"):
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _cache["up"][:n], out=sums[1:])
        return mix64((sums[size:] - sums[:-size]) * _cache["down"][:n - size + 1])


def _sliding(x: np.ndarray, width: int, pick) -> np.ndarray:
    """pick (minimum or maximum) over every ``width`` neighbours, by doubling."""
    have = 1
    while have * 2 <= width:
        x = pick(x[:-have], x[have:])
        have *= 2
    return pick(x[:len(x) - (width - have)], x[width - have:]) if have < width else x


def anchors_of(texts: list[bytes], length: int = LENGTH, piece: int = PIECE):
    """Yield (text number, positions, hashes) of the anchors of every window, for texts of any size, each position once."""
    last, told = -1, np.zeros(0, np.int64)
    for ref, start, at, hashes in _segments(texts, length, piece):
        if ref == last:  # windows on both sides of a border may have the same anchor
            told = told[told >= start]
            new = ~np.isin(at, told)
            at, hashes = at[new], hashes[new]
            told = np.concatenate([told, at])
        else:
            last, told = ref, at
        yield ref, at, hashes


def _segments(texts, length, piece):
    """Yield (text number, first byte, positions, hashes) of the anchors of the windows of every segment, in order."""
    span = length - piece + 1
    parts: list[tuple[int, int, bytes]] = []
    held = 0
    for ref, text in enumerate(texts):
        if len(text) < length:
            continue
        for start in range(0, len(text) - length + 1, SEGMENT):
            part = text[start:start + SEGMENT + length - 1] if len(text) > SEGMENT else text
            parts.append((ref, start, part))
            held += len(part)
            if held >= CHUNK:
                yield from _anchors(parts, length, piece, span)
                parts, held = [], 0
    if parts:
        yield from _anchors(parts, length, piece, span)


def _anchors(parts, length, piece, span):
    data = np.frombuffer(b"".join(p[2] for p in parts), np.uint8)
    sizes = np.array([len(p[2]) for p in parts])
    ends = np.cumsum(sizes)
    starts = ends - sizes
    hashes = piece_hashes(data, piece)
    room = np.repeat(ends, sizes) - np.arange(len(data))  # bytes left in the own part
    hashes[room[:len(hashes)] < piece] = _TOP
    least = _sliding(hashes, span, np.minimum)
    least[room[:len(least)] < length] = 0  # no window starts here
    around = _sliding(np.concatenate([np.zeros(span - 1, np.uint64), least, np.zeros(span - 1, np.uint64)]), span, np.maximum)
    at = np.flatnonzero((around[:len(hashes)] == hashes) & (hashes != _TOP))
    own = np.searchsorted(ends, at, "right")
    edges = np.searchsorted(own, np.arange(len(parts) + 1))
    for i, (ref, start, _) in enumerate(parts):
        mine = at[edges[i]:edges[i + 1]]
        yield ref, start, mine - starts[i] + start, hashes[mine]


def context_of(text: bytes, at: int, length: int, piece: int) -> tuple[int, bytes]:
    """(bytes before the anchor, all bytes) of what windows with the anchor at ``at`` can cover."""
    left = min(at, length - piece)
    return left, text[at - left:at + length]


class _Block:
    """The anchors of one block of texts, in an order that does not depend on how its rows arrived."""

    def __init__(self, table: pa.Table, length: int, piece: int):
        table = table.sort_by([("doc_id", "ascending"), ("text", "ascending")])
        self.ids, self.texts = table.column("doc_id").to_pylist(), table.column("text").to_pylist()
        refs, places, hashes, contexts = [], [], [], []
        for ref, at, own in anchors_of(self.texts, length, piece):
            text = self.texts[ref]
            contexts += [xxhash.xxh3_64_intdigest(c, left) for left, c in (context_of(text, p, length, piece) for p in at.tolist())]
            refs.append(np.full(len(at), ref, np.int32))
            places.append(at)
            hashes.append(own)
        join = lambda x, t: np.concatenate(x).astype(t) if x else np.zeros(0, t)
        self.refs, self.places, self.anchors = join(refs, np.int32), join(places, np.int64), join(hashes, np.uint64)
        self.contexts = np.array(contexts, np.uint64)


def _pair_order(anchors, contexts):
    order = np.lexsort((contexts, anchors))
    a, c = anchors[order], contexts[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (c[1:] != c[:-1])
    return order, np.flatnonzero(new), np.cumsum(new) - 1


def _bucket(keys: np.ndarray, buckets: int) -> np.ndarray:
    return (((mix64(keys) >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)


def _send(length: int, piece: int, buckets: int):
    def run(key, table):
        block = _Block(table, length, piece)
        order, first, group = _pair_order(block.anchors, block.contexts)
        counts = np.minimum(np.bincount(group, minlength=len(first)), 2).astype(np.uint8)
        anchors, contexts = block.anchors[order][first], block.contexts[order][first]
        bucket = _bucket(anchors ^ mix64(contexts), buckets)  # an anchor's contexts are spread over all buckets
        by = np.argsort(bucket, kind="stable")
        edges = np.flatnonzero(np.diff(bucket[by], prepend=-1))
        rows = []
        for lo, hi in zip(edges, [*edges[1:], len(by)]):
            own = by[lo:hi]
            rows.append((int(bucket[own[0]]), key[0].as_py(), anchors[own].tobytes(), contexts[own].tobytes(), counts[own].tobytes()))
        return _table(rows, ("bucket", pa.int32()), ("block", pa.int32()), ("anchors", pa.binary()), ("contexts", pa.binary()),
                      ("counts", pa.binary()))
    return run


def _table(rows, *columns) -> pa.Table:
    return pa.table([pa.array([r[i] for r in rows], t) for i, (_, t) in enumerate(columns)], names=[c for c, _ in columns])


def _numbers(column, kind) -> list[np.ndarray]:
    return [np.frombuffer(x, kind) for x in column.to_pylist()]


def _sorted_pairs(table):
    """The pairs of one bucket by block, and over all of them their order, sorted anchors and where a new pair begins."""
    blocks = table.column("block").to_pylist()
    anchors, contexts = (_numbers(table.column(c), np.uint64) for c in ("anchors", "contexts"))
    a, c = np.concatenate(anchors), np.concatenate(contexts)
    # of equal pairs the one of the least block carries the context on
    order = np.lexsort((np.repeat(blocks, [len(x) for x in anchors]), c, a))
    sa, sc = a[order], c[order]
    new = np.ones(len(sa), bool)
    new[1:] = (sa[1:] != sa[:-1]) | (sc[1:] != sc[:-1])
    return blocks, anchors, contexts, order, sa, new


def _count_contexts(buckets: int):
    """How many different contexts each anchor has in one bucket of pairs, by bucket of the anchor."""
    def run(key, table):
        *_, sa, new = _sorted_pairs(table)
        anchors, n = np.unique(sa[new], return_counts=True)
        bucket = _bucket(anchors, buckets)
        by = np.argsort(bucket, kind="stable")
        edges = np.flatnonzero(np.diff(bucket[by], prepend=-1))
        rows = [(int(bucket[by[lo]]), key[0].as_py(), anchors[by[lo:hi]].tobytes(), n[by[lo:hi]].astype(np.uint32).tobytes())
                for lo, hi in zip(edges, [*edges[1:], len(by)])]
        return _table(rows, ("owner", pa.int32()), ("bucket", pa.int32()), ("anchors", pa.binary()), ("counts", pa.binary()))
    return run


def _open_anchors(group: int):
    """The anchors with several contexts over all buckets, back to the buckets that have pairs of them; HOT if more than ``group``."""
    def run(key, table):
        buckets = table.column("bucket").to_pylist()
        anchors, counts = _numbers(table.column("anchors"), np.uint64), _numbers(table.column("counts"), np.uint32)
        every, inverse = np.unique(np.concatenate(anchors), return_inverse=True)
        total = np.zeros(len(every), np.int64)
        np.add.at(total, inverse, np.concatenate(counts))
        state = (np.where(total > 1, OPEN, 0) | np.where(total > group, HOT, 0)).astype(np.uint8)[inverse]
        rows, at = [], 0
        for bucket, own in zip(buckets, anchors):
            told = state[at:at + len(own)]
            at += len(own)
            if told.any():
                rows.append((bucket, own[told > 0].tobytes(), told[told > 0].tobytes()))
        return _table(rows, ("bucket", pa.int32()), ("anchors", pa.binary()), ("states", pa.binary()))
    return run


def _judge(table, opened):
    """Per (anchor, context): COVERED if it occurs twice, OPEN in one block if its anchor has other contexts, HOT beside OPEN if it has many."""
    columns = (("block", pa.int32()), ("anchors", pa.binary()), ("contexts", pa.binary()), ("verdicts", pa.binary()))
    if not table.num_rows:
        return _table([], *columns)
    blocks, anchors, contexts, order, sa, new = _sorted_pairs(table)
    n = np.concatenate(_numbers(table.column("counts"), np.uint8)).astype(np.int64)
    group = np.cumsum(new) - 1
    total = np.bincount(group, weights=n[order])
    state = np.zeros(len(sa), np.uint8)
    if opened.num_rows:
        known = np.concatenate(_numbers(opened.column("anchors"), np.uint64))
        told = np.concatenate(_numbers(opened.column("states"), np.uint8))
        by = np.argsort(known)
        at = np.minimum(np.searchsorted(known[by], sa), len(known) - 1)
        state = np.where(known[by][at] == sa, told[by][at], 0)
    verdict = np.where(total[group] > 1, COVERED, 0) | np.where(new, state, 0)
    back = np.empty(len(order), np.uint8)
    back[order] = verdict
    rows, at = [], 0
    for block, own_a, own_c in zip(blocks, anchors, contexts):
        v = back[at:at + len(own_a)]
        at += len(own_a)
        told = v > 0
        if told.any():
            rows.append((block, own_a[told].tobytes(), own_c[told].tobytes(), v[told].tobytes()))
    return _table(rows, *columns)


def _merged(refs, starts, ends):
    """Union of the intervals of each text, sorted."""
    order = np.lexsort((starts, refs))
    r, s, e = refs[order], starts[order].astype(np.int64), ends[order].astype(np.int64)
    if not len(r):
        return r, s, e
    wide = int(e.max()) + 2
    reach = np.maximum.accumulate(r.astype(np.int64) * wide + e)
    new = np.ones(len(r), bool)
    new[1:] = r[1:].astype(np.int64) * wide + s[1:] > reach[:-1]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(r)) - 1
    return r[first], s[first], reach[last] - r[first].astype(np.int64) * wide


_FOUND_COLUMNS = (("kind", pa.string()), ("bucket", pa.int32()), ("block", pa.int32()), ("refs", pa.binary()), ("starts", pa.binary()),
                  ("ends", pa.binary()), ("anchor", pa.int64()), ("context", pa.binary()), ("left", pa.int32()), ("keys", pa.binary()))


def window_keys(anchors: np.ndarray, lefts: np.ndarray, contexts: list[bytes], length: int):
    """Per window of every context, in order: number of the context, first byte in it, a key of its bytes and how far the anchor lies in it."""
    sizes = np.array([len(c) for c in contexts])
    n = np.maximum(sizes - length + 1, 0)
    own = np.repeat(np.arange(len(contexts)), n)
    at = np.arange(len(own)) - np.repeat(np.cumsum(n) - n, n)
    windows = piece_hashes(np.frombuffer(b"".join(contexts), np.uint8), length)[(np.cumsum(sizes) - sizes)[own] + at]
    with np.errstate(over="ignore"):
        offset = (lefts[own] - at).astype(np.uint64) * _BASE
        return own, at, mix64(windows ^ mix64(offset + anchors[own]))


def _hot_windows(texts: list[bytes], refs: np.ndarray, places: np.ndarray, length: int, piece: int):
    """Some contexts at a time: yield the text, first byte and key of every window around the anchors at ``places``."""
    step = max(1, CHUNK // (2 * length))
    for lo in range(0, len(refs), step):
        r, p = refs[lo:lo + step], places[lo:lo + step]
        around = [context_of(texts[i], x, length, piece) for i, x in zip(r.tolist(), p.tolist())]
        lefts = np.array([left for left, _ in around])
        anchors = piece_hashes(np.frombuffer(b"".join(c[left:left + piece] for left, c in around), np.uint8), piece)[::piece]
        own, at, keys = window_keys(anchors, lefts, [c for _, c in around], length)
        yield r[own], (p - lefts)[own] + at, keys


def _cells(values: np.ndarray) -> list[bytes]:
    """The bytes of each value."""
    raw, width = values.tobytes(), values.itemsize
    return [raw[k:k + width] for k in range(0, len(raw), width)]


def _examine(length: int, piece: int, buckets: int):
    """Block by block: covered intervals; of open anchors one copy of each context, or its window keys."""
    def run(texts, verdicts):
        if not texts.num_rows:
            return _table([], *_FOUND_COLUMNS)
        block, number = _Block(texts, length, piece), texts.column("block")[0].as_py()
        rows = []
        if verdicts.num_rows:
            a = np.concatenate(_numbers(verdicts.column("anchors"), np.uint64))
            c = np.concatenate(_numbers(verdicts.column("contexts"), np.uint64))
            v = np.concatenate(_numbers(verdicts.column("verdicts"), np.uint8))
            n = len(block.anchors)
            order, first, group = _pair_order(np.concatenate([block.anchors, a]), np.concatenate([block.contexts, c]))
            pair = np.empty(len(order), np.int64)
            pair[order] = group
            told = np.zeros(len(first), np.uint8)
            told[pair[n:]] = v
            state = told[pair[:n]]
            covered = np.flatnonzero(state & COVERED)
            place = block.places[covered]
            sizes = np.array([len(t) for t in block.texts])
            starts = np.maximum(place - (length - piece), 0)
            ends = np.minimum(place + length, sizes[block.refs[covered]])
            r, s, e = _merged(block.refs[covered], starts, ends)
            if len(r):
                rows.append(("run", None, number, r.astype(np.int32).tobytes(), s.tobytes(), e.tobytes(), None, None, None, None))
            opened = np.flatnonzero(state & OPEN)
            opened = opened[np.sort(np.unique(pair[opened], return_index=True)[1])]  # one copy of each context
            hot = opened[(state[opened] & HOT) > 0]
            opened = opened[(state[opened] & HOT) == 0]
            refs, places, anchors = block.refs[opened], block.places[opened], block.anchors[opened]
            around = [context_of(block.texts[r], p, length, piece) for r, p in zip(refs.tolist(), places.tolist())]
            rows += [("open", b, number, r, p, twice, anchor, context, left, None) for b, r, p, twice, anchor, (left, context)
                     in zip(_bucket(anchors, buckets).tolist(), _cells(refs), _cells(places), _cells(state[opened] & np.uint8(COVERED)),
                            (anchors ^ np.uint64(2**63)).view(np.int64).tolist(), around)]
            if len(hot):
                refs, places = block.refs[hot], block.places[hot]
                rows.append(("place", None, number, refs.tobytes(), places.tobytes(), None, None, None, None, None))
                keys = np.concatenate([k for _, _, k in _hot_windows(block.texts, refs, places, length, piece)])
                bucket = _bucket(keys, buckets)
                by = np.argsort(bucket, kind="stable")
                edges = np.flatnonzero(np.diff(bucket[by], prepend=-1))
                for lo, hi in zip(edges, [*edges[1:], len(by)]):
                    rows.append(("keys", int(bucket[by[lo]]), number, None, None, None, None, None, None, keys[by[lo:hi]].tobytes()))
        return _table(rows, *_FOUND_COLUMNS)
    return run


def _repeated_keys(key, table):
    """Keys that occur more than once, back to the blocks that have them."""
    blocks, keys = table.column("block").to_pylist(), _numbers(table.column("keys"), np.uint64)
    every, inverse, counts = np.unique(np.concatenate(keys), return_inverse=True, return_counts=True)
    again, at, rows = counts[inverse] > 1, 0, []
    for block, own in zip(blocks, keys):
        mine = own[again[at:at + len(own)]]
        at += len(own)
        if len(mine):
            rows.append((block, np.unique(mine).tobytes()))
    return _table(rows, ("block", pa.int32()), ("keys", pa.binary()))


def aligned_suffix_arrays(family: np.ndarray, lefts: np.ndarray, contexts: list[bytes]):
    """Suffix arrays of contexts, one for each distance d of the suffix from the anchor, d = 0, 1, 2, ...

    Yield (d, order, shared): the contexts with at least d bytes before the anchor,
    sorted by family and by their bytes from d before the anchor on, and how many
    bytes each shares with the one before it (0 across families). The array of d
    follows from that of d - 1 by induced sorting: a stable sort by the byte added in
    front. Two neighbours with the same new byte share one byte more than the least
    that was shared anywhere between them, a range minimum.
    """
    n = len(contexts)
    tails = [c[l:] for c, l in zip(contexts, lefts.tolist())]
    heads = [c[:l][::-1] for c, l in zip(contexts, lefts.tolist())]
    order = np.array(sorted(range(n), key=lambda i: (family[i], tails[i])), np.int64)
    sizes = np.array([len(t) for t in tails])
    width, depth = int(sizes.max()), int(lefts.max())
    after = np.frombuffer(b"".join(t.ljust(width, b"\0") for t in tails), np.uint8).reshape(n, width)
    ahead = np.frombuffer(b"".join(h.ljust(depth + 1, b"\0") for h in heads), np.uint8).reshape(n, depth + 1)
    shared = np.zeros(n, np.int64)
    if n > 1:
        x, y = order[:-1], order[1:]
        differ = after[x] != after[y]
        first = np.where(differ.any(1), differ.argmax(1), width)
        shared[1:] = np.where(family[x] == family[y], np.minimum(first, np.minimum(sizes[x], sizes[y])), 0)
    yield 0, order, shared
    small = family.astype(np.uint16) if family.max() < 65536 else family
    for d in range(1, depth + 1):
        at = np.flatnonzero(lefts[order] >= d)
        byte = ahead[order, d - 1]
        at = at[np.argsort(byte[at], kind="stable")]
        at = at[np.argsort(small[order[at]], kind="stable")]
        x, y = at[:-1], at[1:]
        same = np.flatnonzero((byte[x] == byte[y]) & (family[order[x]] == family[order[y]]))
        grown = np.zeros(len(at), np.int64)
        grown[same + 1] = 1 + _range_minimum(shared, x[same] + 1, y[same] + 1)
        order, shared = order[at], grown
        yield d, order, shared


def _range_minimum(values: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Least of ``values[first:end]`` for each pair, from minima over powers of two."""
    out = np.empty(len(first), values.dtype)
    if not len(first):
        return out
    power = np.frexp((end - first).astype(float))[1] - 1
    table = values
    for k in range(int(power.max()) + 1):
        if k:
            half = 1 << (k - 1)
            table = np.minimum(table[:-half], table[half:])
        own = np.flatnonzero(power == k)
        out[own] = np.minimum(table[first[own]], table[end[own] - (1 << k)])
    return out


def _nearest_smaller(values: np.ndarray, at: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
    """For each place in ``at`` the nearest place of a smaller value, to the left (step -1) or right (1), and if an equal one lies between.

    All of ``at`` jump together, over what those they land on have jumped over already.
    """
    near, equal = np.arange(len(values)) + step, np.zeros(len(values), bool)
    todo = at
    while len(todo):
        land = near[todo]
        equal[todo] |= values[land] == values[todo]
        more = values[land] >= values[todo]
        todo = todo[more]
        near[todo] = near[land[more]]
    return near[at], equal[at]


def _prefix_intervals(prefixes: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last suffix and common prefix of every interval of suffixes sharing at least ``least`` bytes, all at once."""
    values = np.append(np.where(prefixes >= least, prefixes, 0), 0)
    starts = np.flatnonzero(np.append(True, values[1:] != values[:-1]))  # of runs of equal values
    values = values[starts]
    at = np.flatnonzero(values)
    first, again = _nearest_smaller(values, at, -1)
    end, _ = _nearest_smaller(values, at, 1)
    own = ~again  # an interval is told by the first of its least values
    return starts[first[own] + 1] - 1, starts[end[own]] - 1, values[at[own]]


def common_prefix_intervals(prefixes: np.ndarray, least: int):
    """Yield (first, last, common prefix) of every interval of suffixes sharing at least ``least`` bytes.

    ``prefixes[i]`` is what suffix i shares with suffix i - 1; the first is 0.
    """
    yield from zip(*(x.tolist() for x in _prefix_intervals(prefixes, least)))


def _maximal_groups(anchors: np.ndarray, lefts: np.ndarray, contexts: list[bytes], length: int):
    """Per distance d of the suffixes from the anchor that has any: (d, order, first, last, common) of the maximal repeat groups."""
    _, family = np.unique(anchors, return_inverse=True)
    ahead = [c[:l][::-1] for c, l in zip(contexts, lefts.tolist())]
    depth = int(lefts.max()) + 1
    before_all = np.frombuffer(b"".join(h.ljust(depth, b"\0") for h in ahead), np.uint8).reshape(len(contexts), depth)
    for d, order, shared in aligned_suffix_arrays(family, lefts, contexts):
        first, last, common = _prefix_intervals(shared, length)
        if not len(first):
            continue
        before = np.where(lefts[order] > d, before_all[order, min(d, depth - 1)].astype(np.int64), -1 - np.arange(len(order)))
        changes = np.cumsum(np.concatenate([[0], before[1:] != before[:-1]]))
        diverse = changes[last] > changes[first]
        if diverse.any():
            yield d, order, first[diverse], last[diverse], common[diverse]


def maximal_repeats(anchors: np.ndarray, lefts: np.ndarray, contexts: list[bytes], length: int):
    """Maximal repeat groups among contexts: yield (context numbers, starts in them, common length).

    Suffixes are compared only with suffixes at the same distance from the same
    anchor, so two occurrences are always different places of the corpus. A group
    is maximal if its occurrences continue differently to the right and have
    different bytes, or none within the context, to the left.
    """
    for d, order, *groups in _maximal_groups(anchors, lefts, contexts, length):
        for first, last, common in zip(*(g.tolist() for g in groups)):
            own = order[first:last + 1]
            yield own, lefts[own] - d, common


def covered_by_repeats(anchors: np.ndarray, lefts: np.ndarray, contexts: list[bytes], length: int):
    """Per context the bytes before and after the start of its anchor that its maximal repeats cover, -1 before if it has none.

    A repeat of ``length`` bytes holds the start of the anchor, which is less than ``length`` bytes
    from every suffix, so the union of the repeats of a context is one interval.
    """
    ahead, after = np.full(len(contexts), -1), np.zeros(len(contexts), np.int64)
    for d, order, *groups in _maximal_groups(anchors, lefts, contexts, length):
        reach = np.zeros(len(order), np.int64)
        by = np.argsort(groups[2], kind="stable")  # a group lies inside those that share less
        for first, last, common in zip(*(g[by].tolist() for g in groups)):
            reach[first:last + 1] = common
        hit = np.flatnonzero(reach)
        own = order[hit]
        ahead[own] = d  # distances grow
        after[own] = np.maximum(after[own], reach[hit] - d)
    return ahead, after


def _intervals(length: int):
    """The open contexts of a bucket: what its maximal repeat groups cover, back to the blocks."""
    def run(key, table):
        table = table.sort_by([("anchor", "ascending"), ("block", "ascending"), ("refs", "ascending"), ("starts", "ascending")])
        anchors = table.column("anchor").to_numpy()
        blocks, lefts = table.column("block").to_numpy(), table.column("left").to_numpy().astype(np.int64)
        refs = np.concatenate(_numbers(table.column("refs"), np.int32))
        places = np.concatenate(_numbers(table.column("starts"), np.int64))
        contexts = table.column("context").to_pylist()
        edges = np.append(np.flatnonzero(np.append(True, anchors[1:] != anchors[:-1])), len(anchors))
        sizes = np.append(0, np.cumsum([len(c) for c in contexts]))
        ahead, after, lo = np.empty(len(anchors), np.int64), np.empty(len(anchors), np.int64), 0
        while lo < len(anchors):  # some megabytes of whole anchor groups at a time
            enough = edges[edges > lo]
            hi = int(enough[min(np.searchsorted(sizes[enough], sizes[lo] + BATCH), len(enough) - 1)])
            ahead[lo:hi], after[lo:hi] = covered_by_repeats(anchors[lo:hi], lefts[lo:hi], contexts[lo:hi], length)
            lo = hi
        own = np.flatnonzero(ahead >= 0)
        starts, ends = places[own] - ahead[own], places[own] + after[own]
        by = np.argsort(blocks[own], kind="stable")
        edges = np.flatnonzero(np.diff(blocks[own][by], prepend=-1))
        rows = []
        for lo, hi in zip(edges, [*edges[1:], len(by)]):
            mine = by[lo:hi]
            r, s, e = _merged(refs[own[mine]], starts[mine], ends[mine])
            rows.append((int(blocks[own[mine[0]]]), r.astype(np.int32).tobytes(), s.tobytes(), e.tobytes()))
        return _table(rows, ("block", pa.int32()), ("refs", pa.binary()), ("starts", pa.binary()), ("ends", pa.binary()))
    return run


def _remove(length: int, piece: int):
    def run(texts, found):
        if not texts.num_rows:
            return _table([], ("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
                          ("kept_sha256", pa.string()))
        texts = texts.sort_by([("doc_id", "ascending"), ("text", "ascending")])
        raw = texts.column("text").to_pylist()
        refs, starts, ends = [], [], []
        kinds = found.column("kind").to_pylist()
        run_rows = found.filter(pa.array([k == "run" for k in kinds], pa.bool_()))
        refs += _numbers(run_rows.column("refs"), np.int32)
        starts += _numbers(run_rows.column("starts"), np.int64)
        ends += _numbers(run_rows.column("ends"), np.int64)
        repeated = [x for x in _numbers(found.filter(pa.array([k == "again" for k in kinds], pa.bool_())).column("keys"), np.uint64)]
        if repeated:
            again = np.unique(np.concatenate(repeated))
            for r, at in zip(*(_numbers(found.filter(pa.array([k == "place" for k in kinds], pa.bool_())).column(c), t)
                               for c, t in (("refs", np.int32), ("starts", np.int64)))):
                for ref, first, keys in _hot_windows(raw, r, at, length, piece):
                    hit = again[np.minimum(np.searchsorted(again, keys), len(again) - 1)] == keys
                    for x, part in zip((refs, starts, ends), _merged(ref[hit], first[hit], first[hit] + length)):
                        x.append(part)
        if refs:
            r, s, e = _merged(np.concatenate(refs), np.concatenate(starts), np.concatenate(ends))
        else:
            r, s, e = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)
        edges = np.searchsorted(r, np.arange(len(raw) + 1))
        rows = []
        for i, (doc_id, text) in enumerate(zip(texts.column("doc_id").to_pylist(), raw)):
            own, at, digest = range(edges[i], edges[i + 1]), 0, hashlib.sha256()
            for k in own:
                digest.update(text[at:s[k]])
                at = int(e[k])
            digest.update(text[at:])
            removed = int((e[edges[i]:edges[i + 1]] - s[edges[i]:edges[i + 1]]).sum())
            rows.append((doc_id, len(text), removed, len(own), digest.hexdigest()))
        return _table(rows, ("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
                      ("kept_sha256", pa.string()))
    return run


def repeated_passages(docs: DataFrame, length: int = LENGTH, piece: int = PIECE) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256 of the bytes left.

    Null text is empty; texts shorter than ``length`` lose nothing; null ids are
    carried along; a repeated row repeats its text, so all its windows go. Extra
    columns are ignored; an empty table gives no rows.
    """
    blocks = block_count(docs, block_bytes=BLOCK)
    rows = doc_bytes(docs).withColumn("block", block_of(blocks))
    dealt = rows.repartition(partitions_of(docs.sparkSession), "block")
    pairs = dealt.groupBy("block").applyInArrow(_send(length, piece, blocks), _PAIRS)
    counted = pairs.groupBy("bucket").applyInArrow(_count_contexts(blocks), _CONTEXTS)
    opened = counted.groupBy("owner").applyInArrow(_open_anchors(GROUP), _OPENED)
    verdicts = pairs.groupBy("bucket").cogroup(opened.groupBy("bucket")).applyInArrow(_judge, _VERDICTS)
    found = stored(dealt.groupBy("block").cogroup(verdicts.groupBy("block")).applyInArrow(_examine(length, piece, blocks), _FOUND), "repeat-contexts")
    none = F.lit(None).cast("binary")
    repeats = (found.filter("kind = 'open'").groupBy("bucket").applyInArrow(_intervals(length), _RUNS)
                    .select("block", F.lit("run").alias("kind"), "refs", "starts", "ends", none.alias("keys")))
    again = (found.filter("kind = 'keys'").groupBy("bucket").applyInArrow(_repeated_keys, "block int, keys binary")
                  .select("block", F.lit("again").alias("kind"), none.alias("refs"), none.alias("starts"), none.alias("ends"), "keys"))
    direct = found.filter("kind IN ('run', 'place')").select("block", "kind", "refs", "starts", "ends", "keys")
    return dealt.groupBy("block").cogroup(direct.unionByName(repeats).unionByName(again).groupBy("block")).applyInArrow(
        _remove(length, piece), _ROWS)
