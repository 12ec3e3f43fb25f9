"""Secret scan: fixed patterns, and formats inferred from the credentials those find.

The values the fixed patterns find are labelled credentials. Their prefix tree,
over character classes, is folded by merging states whose outgoing frequencies
are statistically compatible (Hoeffding bound), giving a probabilistic automaton.
Ordinary tokens give a second one. Every other token-like string of at least the length
of the shortest labelled value is scored by the log-likelihood ratio of the two, and
becomes a span if it is far more likely a credential, and no less likely per character than
the least likely labelled value.

Texts are read twice in Arrow batches and nothing of them is stored. The first pass
sends the labelled values and token-like strings of least hash of each batch, so that
both automata learn from a bounded sample of all there are; the second finds the fixed
patterns and scores all candidates where they stand, each different one once per task.
"""

from __future__ import annotations

import heapq
import math
import re
from collections import deque

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import doc_bytes, sha256_hex, stored

# The base patterns, their least lengths, and the keywords without which the first cannot match.
ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # the maximal runs of [0-9a-f]+ that are long enough
LEAST = {"assign": 6, "access": 20, "hex": 24}
KINDS = ("assign", "access", "hex", "learned")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{6,}")  # maximal runs as long as the shortest labelled value

SAMPLE = 2000
ALPHA = 0.05
MARGIN = math.log(1000.0)

MEMO = 400_000

_SPANS = ("doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_learned long, best_score double")
_CLASSES = str.maketrans({**dict.fromkeys("abcdef", "a"), **dict.fromkeys("ghijklmnopqrstuvwxyz", "z"),
                          **dict.fromkeys("ABCDEF", "A"), **dict.fromkeys("GHIJKLMNOPQRSTUVWXYZ", "Z"),
                          **dict.fromkeys("0123456789", "0")})


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(start, end, kind number, value) of the fixed patterns, by start, then kind."""
    found = []
    low = text.lower()
    if any(k in low for k in KEYWORDS):
        found += [(m.start(), m.end(), 0, m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    if "AKIA" in text:
        found += [(m.start(), m.end(), 1, m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST["access"]]
    found += [(m.start(), m.end(), 2, m[0]) for m in HEX.finditer(text)]
    return sorted(found, key=lambda x: (x[0], x[2]))


def candidates(text: str, base: list):
    """The matches of token-like strings that no base span touches."""
    k, reach = 0, 0
    for m in CANDIDATE.finditer(text):
        while k < len(base) and base[k][0] < m.end():
            reach = max(reach, base[k][1])
            k += 1
        if reach <= m.start():
            yield m


def _least(values, size: int) -> list[tuple[int, str]]:
    """The ``size`` different values of least hash, with their hashes."""
    return heapq.nsmallest(size, {(xxhash.xxh3_64_intdigest(v.encode()) - 2**63, v) for v in values})


def _samples(size: int):
    """Per batch, the labelled values and the ordinary token-like strings of least hash."""
    def run(batches):
        for b in batches:
            labelled, ordinary = set(), set()
            for raw in b.column(1):
                text = raw.as_py().decode("utf-8", "replace")
                base = base_spans(text)
                labelled.update(x[3] for x in base)
                ordinary.update(m[0] for m in candidates(text, base))
                if len(ordinary) > 50 * size:
                    ordinary = {v for _, v in _least(ordinary, size)}
            rows = [(True, *x) for x in _least(labelled, size)] + [(False, *x) for x in _least(ordinary, size)]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.bool_(), pa.int64(), pa.string()))],
                                             names=["labelled", "hash", "value"])
    return run


class Automaton:
    """Deterministic probabilistic automaton; ``states`` is a list of (visits, ends, {symbol: (target, count)})."""

    def __init__(self, states: list[tuple[int, int, dict]], symbols: int):
        self.states, self.symbols = states, max(1, symbols)

    def log_likelihood(self, value: str) -> float:
        """Natural log of the probability of the class string; half a count for what was never seen."""
        total, at = 0.0, 0
        for c in value.translate(_CLASSES):
            if at is None:
                total -= math.log(self.symbols + 1)
                continue
            visits, _, out = self.states[at]
            target, count = out.get(c, (None, 0))
            total += math.log((count + 0.5) / (visits + 0.5 * (self.symbols + 1)))
            at = target
        if at is None:
            return total - math.log(self.symbols + 1)
        visits, ends, _ = self.states[at]
        return total + math.log((ends + 0.5) / (visits + 0.5 * (self.symbols + 1)))


class _Learner:
    """Prefix tree whose states are folded together, nearest to the root first."""

    def __init__(self, values: list[str], alpha: float):
        self.visits, self.ends, self.out = [0], [0], [{}]
        self.bound = math.sqrt(0.5 * math.log(2.0 / alpha))
        for v in values:
            at = 0
            self.visits[0] += 1
            for c in v.translate(_CLASSES):
                if c not in self.out[at]:
                    self.out[at][c] = [len(self.visits), 0]
                    self.visits.append(0)
                    self.ends.append(0)
                    self.out.append({})
                self.out[at][c][1] += 1
                at = self.out[at][c][0]
                self.visits[at] += 1
            self.ends[at] += 1

    def _close(self, f1: int, n1: int, f2: int, n2: int) -> bool:
        return n1 == 0 or n2 == 0 or abs(f1 / n1 - f2 / n2) <= self.bound * (n1 ** -0.5 + n2 ** -0.5)

    def _compatible(self, a: int, b: int) -> bool:
        stack = [(a, b)]
        while stack:
            a, b = stack.pop()
            if a == b:
                continue
            if not self._close(self.ends[a], self.visits[a], self.ends[b], self.visits[b]):
                return False
            for c in self.out[a].keys() | self.out[b].keys():
                x, y = self.out[a].get(c, (None, 0)), self.out[b].get(c, (None, 0))
                if not self._close(x[1], self.visits[a], y[1], self.visits[b]):
                    return False
                if x[0] is not None and y[0] is not None:
                    stack.append((x[0], y[0]))
        return True

    def _fold(self, into: int, tree: int) -> None:
        stack = [(into, tree)]
        while stack:
            into, tree = stack.pop()
            self.visits[into] += self.visits[tree]
            self.ends[into] += self.ends[tree]
            for c, (child, count) in self.out[tree].items():
                if c in self.out[into]:
                    self.out[into][c][1] += count
                    stack.append((self.out[into][c][0], child))
                else:
                    self.out[into][c] = [child, count]

    def learn(self) -> list[tuple[int, int, dict]]:
        red, blue = [0], deque((0, c) for c in sorted(self.out[0]))
        done = {0}
        while blue:
            parent, c = blue.popleft()
            state = self.out[parent][c][0]
            if state in done:
                continue
            match = next((r for r in red if self._compatible(r, state)), None)
            if match is None:
                red.append(state)
                done.add(state)
                blue.extend((state, x) for x in sorted(self.out[state]))
            else:
                self.out[parent][c][0] = match
                self._fold(match, state)
                blue.extend((r, x) for r in red for x in sorted(self.out[r]) if self.out[r][x][0] not in done)
        number = {s: i for i, s in enumerate(red)}
        return [(self.visits[s], self.ends[s], {c: (number[t], k) for c, (t, k) in self.out[s].items()}) for s in red]


def learn_automaton(values: list[str], alpha: float = ALPHA) -> Automaton:
    """Merge the compatible states of the prefix tree of ``values``."""
    symbols = len({c for v in values for c in v.translate(_CLASSES)})
    return Automaton(_Learner(values, alpha).learn(), symbols)


def samples(docs: DataFrame, size: int = SAMPLE) -> tuple[list[str], list[str]]:
    """Labelled values and ordinary token-like strings: at most ``size`` different ones each, those of least hash of all texts."""
    rows = doc_bytes(docs).mapInArrow(_samples(size), "labelled boolean, hash long, value string").distinct()
    pick = lambda which: [r["value"] for r in rows.filter(which).orderBy("hash", "value").limit(size).collect()]
    rows = stored(rows, "secret-samples")
    return pick(F.col("labelled")), pick(~F.col("labelled"))


class Scores(dict):
    """Token-like string -> log-likelihood ratio, at most 0 for what no labelled value is like; emptied when it has grown large."""

    def __init__(self, labelled: list[str], ordinary: list[str], alpha: float = ALPHA):
        super().__init__()
        self.credential, self.ordinary = learn_automaton(labelled, alpha), learn_automaton(ordinary, alpha)
        self.least = min((self.credential.log_likelihood(v) / (len(v) + 1) for v in labelled), default=0.0)

    def __missing__(self, value: str) -> float:
        own = self.credential.log_likelihood(value)
        found = own - self.ordinary.log_likelihood(value)
        if own < self.least * (len(value) + 1):
            found = min(found, 0.0)
        if len(value) <= 64:
            if len(self) > MEMO:
                self.clear()
            self[value] = found
        return found


def _scan(scores: Scores, margin: float):
    names = [x.split()[0] for x in _SPANS.split(", ")]
    types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.float64())

    def run(batches):
        for b in batches:
            rows = []
            for doc_id, raw in zip(b.column(0).to_pylist(), b.column(1)):
                text = raw.as_py().decode("utf-8", "replace")
                base = base_spans(text)
                spans, learned, best = [x[:3] for x in base], 0, None
                for m in candidates(text, base):
                    score = scores[m[0]]
                    if best is None or score > best:
                        best = score
                    if score >= margin:
                        spans.append((m.start(), m.end(), len(KINDS) - 1))
                        learned += 1
                told = lambda found: ",".join(f"{KINDS[k]}:{s}:{e}" for s, e, k in found)
                rows.append((doc_id, *(sum(x[2] == k for x in base) for k in range(3)), sha256_hex(told(x[:3] for x in base).encode()),
                             told(sorted(spans, key=lambda x: (x[0], x[2]))), learned, best))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=names)
    return run


def scan_secrets(docs: DataFrame, sample: int = SAMPLE, alpha: float = ALPHA, margin: float = MARGIN) -> DataFrame:
    """Per document: counts and digest of the base spans, all spans, and the best score of a candidate.

    Both automata learn from at most ``sample`` different values each, those of least
    hash; patterns and scoring cover every text whole, every token-like string of six or more
    characters. Without labelled values nothing is added. Spans that start together come in
    the order of the kinds. Null text is empty and has no spans; null ids, repeated rows
    and extra columns pass through or are ignored; an empty table gives no rows. A text is
    held whole by one task.
    """
    labelled, ordinary = samples(docs, sample)
    return doc_bytes(docs).mapInArrow(_scan(Scores(labelled, ordinary, alpha), margin if labelled else math.inf), _SPANS)
