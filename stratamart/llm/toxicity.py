"""Toxicity by weak supervision.

Voters look at a whole text: fixed lexicons, patterns, and words and word
beginnings mined from a bounded number of labelled training rows. A generative label model over the vote patterns of
all training rows estimates by expectation-maximisation how often each voter
fires on toxic and on clean texts, and from the residual second moments how far
voters repeat each other; correlated voters share their weight. Its posterior
labels train a logistic classifier on vote rates. Texts are read once for the
words of labelled rows and once for the votes; everything later works on stored
votes and on sums of fixed size.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import doc_bytes, id_remainder, slices, stored, text_mark, without
from .linear import matrix_sum, stack

HELD_OUT, HELD_REMAINDER = 3, 1
MINED = 48
MINING_ROWS = 40_000
STEM = (3, 8)
ROUNDS = 8
NEWTON = 8
UNITS_HELD = 200_000  # by a task that counts them, before it sends them
WORDS_HELD = 150_000  # whose voters a task remembers

# Words of abuse by kind, in the languages of the corpus.
LEXICONS = {
    "insult": "idiot idiots idiotic moron morons moronic imbecile imbeciles dumb dumbass fool fools jerk jerks",
    "stupidity": "stupid stupidity brainless dimwit halfwit retard retarded ignorant",
    "contempt": "loser losers clown clowns pathetic coward cowards freak freaks weakling",
    "disgust": "disgusting filthy filth vile vermin scum scumbag trash garbage pig pigs rat rats sickening",
    "worth": "worthless useless nobody hopeless failure disgrace",
    "profanity": "fuck fucking fucked shit shitty bitch bastard bastards asshole crap bullshit whore slut",
    "threat": "kill murder strangle hang beat destroy",
    "german": "idiot idioten dummkopf trottel abschaum dreckig wertlos widerlich arschloch scheisse schlampe versager",
    "french": "idiote idiots imbécile connard connasse salaud salope ordure minable nul crétin dégoûtant pourri",
    "spanish": "idiota idiotas imbécil estúpido estúpida basura asqueroso asquerosa inútil patético escoria cabrón puta",
}
PATTERNS = {
    "addressed": r"\b(?:you|you're|youre|u)\s+(?:are\s+)?(?:an?\s+|such\s+an?\s+|so\s+|all\s+)?(?:idiot|moron|loser|clown|stupid|pathetic|worthless|disgusting|scum|trash)",
    "dismissal": r"\b(?:shut up|go away|get lost|drop dead|go to hell|hate you)\b",
    "masked": r"\b[a-z]\*{2,}[a-z]*\b|\b[a-z]+\*{2,}[a-z]\b",
    "shouting": r"(?:[A-Z]{3,}[^A-Za-z]+){4}",
    "exclaiming": r"!{3,}|\?!{2,}",
}
_WORD = re.compile(r"[^\W\d_]+")
_FIXED = {name: frozenset(words.split()) for name, words in LEXICONS.items()}
_MATCH = {name: re.compile(p) for name, p in PATTERNS.items()}
# What a text must hold for a pattern to match at all: looked for first, which is much faster.
_NEEDS = {"addressed": ("idiot", "moron", "loser", "clown", "stupid", "pathetic", "worthless", "disgusting", "scum", "trash"),
          "dismissal": ("shut up", "go away", "get lost", "drop dead", "go to hell", "hate you"), "masked": ("**",), "shouting": (),
          "exclaiming": ("!!!", "?!")}
_CASELESS = ("addressed", "dismissal", "masked")


def _thinning_key(text: bytes) -> int:
    """Least hash of the runs of three words: equal for most near copies, hardly ever for other texts."""
    w = text.lower().split()
    runs = map(b" ".join, zip(w, w[1:], w[2:])) if len(w) > 3 else [b" ".join(w)]
    return min(map(xxhash.xxh3_64_intdigest, runs)) - 2**63


def _with_key(batches):
    for b in batches:
        keys = [_thinning_key(t) for part in slices(b) for t in part.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column("text"), b.column("label"), pa.array(keys, pa.int64())], names=["text", "label", "key"])


def _units(word: str) -> list[str]:
    """The word itself, marked by a dollar sign, and its beginnings."""
    return [word + "$", *(word[:k] for k in range(STEM[0], min(STEM[1], len(word)) + 1))]


def _unit_counts(batches):
    def flush():
        units = list(counts[0].keys() | counts[1].keys())
        return pa.RecordBatch.from_arrays([pa.array(units, pa.string()), pa.array([counts[1][u] for u in units], pa.int64()),
                                           pa.array([counts[0][u] for u in units], pa.int64())], names=["unit", "a", "b"])

    counts = Counter(), Counter()
    for b in (part for batch in batches for part in slices(batch)):
        for text, label in zip(b.column("text").to_pylist(), b.column("label").to_pylist()):
            words = set(_WORD.findall(text.decode("utf-8", "replace").lower()))
            counts[label].update({u for w in words for u in _units(w)})
        if len(counts[0]) + len(counts[1]) > UNITS_HELD:
            yield flush()
            counts = Counter(), Counter()
    yield flush()


def mined_units(texts: DataFrame, marked: DataFrame, size: int = MINED, rows: int = MINING_ROWS, least: float = 1.5) -> list[str]:
    """Words and word beginnings that speak most for toxicity, by log odds less two deviations.

    ``texts`` has doc_id and text, ``marked`` _id and label. At most about ``rows``
    labels are used, chosen by a hash of the id; being that few, they are broadcast
    and the texts are not shuffled. Of the labelled texts with the same least
    run of three words, mostly near copies, one counts: the least by its bytes. Of units that
    are beginnings of each other the best stays. A unit of fewer than five toxic texts is no unit.
    """
    ring = 1_000_000
    share = min(1.0, rows / max(1, marked.count()))
    chosen = F.broadcast(marked.filter(F.pmod(F.xxhash64("_id"), F.lit(ring)) < int(ring * share)))
    keyed = texts.join(chosen, F.col("doc_id") == F.col("_id")).select("text", "label").mapInArrow(_with_key, "text binary, label int, key long")
    texts = stored(keyed.groupBy("key").agg(F.min(F.struct("text", "label")).alias("x")).select("x.text", "x.label"), "toxicity-mining")
    counts = texts.mapInArrow(_unit_counts, "unit string, a long, b long").groupBy("unit").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    n1, n0 = texts.agg(F.sum("label"), F.sum(1 - F.col("label"))).first()
    if not n1 or not n0:
        return []
    odds = F.log((F.col("a") + 0.5) / (F.lit(n1) - F.col("a") + 0.5)) - F.log((F.col("b") + 0.5) / (F.lit(n0) - F.col("b") + 0.5))
    deviation = F.sqrt(1 / (F.col("a") + 0.5) + 1 / (F.col("b") + 0.5))
    best = (counts.filter("a >= 5").withColumn("low", odds - 2 * deviation).filter(F.col("low") > least)
                  .orderBy(F.desc("low"), F.length("unit"), "unit").limit(40 * size))
    kept: list[str] = []
    for r in best.collect():
        u = r["unit"].rstrip("$")
        if len(kept) < size and not any(k.rstrip("$").startswith(u) or u.startswith(k.rstrip("$")) for k in kept):
            kept.append(r["unit"])
    return kept


class _Memo(dict):
    """Word -> numbers of the voters it counts for; emptied when it has grown large."""

    def __init__(self, whole: dict[str, list[int]], stems: dict[str, int]):
        super().__init__()
        self.whole, self.stems = whole, stems

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) > WORDS_HELD:
            self.clear()
        own = list(self.whole.get(word, ()))
        own += [self.stems[u] for u in _units(word) if u in self.stems]
        self[word] = found = tuple(own)
        return found


class Voters:
    """The votes of one text: hits per voter, in a fixed order."""

    def __init__(self, mined: list[str]):
        whole: dict[str, list[int]] = {}
        for k, words in enumerate(_FIXED.values()):
            for w in words:
                whole.setdefault(w, []).append(k)
        stems = {u: len(_FIXED) + i for i, u in enumerate(mined)}
        self.names = [*_FIXED, *(f"mined:{u}" for u in mined), *_MATCH]
        self.words = len(_FIXED) + len(mined)
        self.memo = _Memo(whole, stems)

    def hits(self, text: str) -> tuple[list[int], int]:
        low = text.lower()
        words = _WORD.findall(low)
        out = [0] * len(self.names)
        for own in filter(None, map(self.memo.__getitem__, words)):
            for k in own:
                out[k] += 1
        for k, (name, pattern) in enumerate(_MATCH.items(), self.words):
            where = low if name in _CASELESS else text
            if not _NEEDS[name] or any(x in where for x in _NEEDS[name]):
                out[k] = sum(1 for _ in pattern.finditer(where))
        return out, len(words)


def _votes(voters: Voters):
    width = len(voters.names)

    def run(batches):
        for b in batches:
            rows = []
            for text in (t for part in slices(b) for t in part.column("text").to_pylist()):
                hits, n = voters.hits(text.decode("utf-8", "replace"))
                rows.append(np.array([*hits, n], np.float64).tobytes())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("remainder"), b.column("mark"), pa.array(rows, pa.binary())],
                                             names=["doc_id", "remainder", "mark", "hits"])
    return run, width


class LabelModel:
    """P(toxic) and each voter's firing rate on toxic and clean texts; correlated voters share their weight.

    A voter that does not fire abstains: a lexicon of one language says nothing about
    another. A text on which none fires has the rate of toxic texts among such.
    """

    def __init__(self, prior: float, toxic: np.ndarray, clean: np.ndarray, silent: float):
        self.prior, self.toxic, self.clean, self.silent = prior, toxic, clean, silent
        self.share = np.ones(len(toxic))

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        p, q = np.clip(self.toxic, 1e-4, 1 - 1e-4), np.clip(self.clean, 1e-4, 1 - 1e-4)
        logit = math.log(self.prior / (1 - self.prior)) + votes @ (np.log(p / q) * self.share)
        return np.where(votes.any(1), 1 / (1 + np.exp(-np.clip(logit, -40, 40))), self.silent)


def fit_label_model(patterns: DataFrame, seen: np.ndarray, width: int, rounds: int = ROUNDS) -> LabelModel:
    """EM over ``patterns`` (votes packed, n), begun at the rates ``seen`` on labelled rows.

    ``seen`` holds, for clean and toxic labelled rows, the count, the firings of each
    voter and the rows on which none fires. They stay in every round as fixed evidence,
    and the unlabelled rows together weigh no more than they do.
    """
    (n0, *f0, none0), (n1, *f1, none1) = seen
    f0, f1 = np.array(f0), np.array(f1)
    rates = lambda fired, n: (fired + 0.5) / (n + 1.0)
    if n1 and n0:
        silent = (none1 + 0.5) / (none0 + none1 + 10.0)
        model = LabelModel((n1 + 1) / (n0 + n1 + 2), rates(f1, n1), rates(f0, n0), silent)
    else:
        silent = 0.01
        model = LabelModel(0.1, np.full(width, 0.3), np.full(width, 0.02), silent)

    def expected(b):
        votes, n = stack(b.column("votes"), width), np.asarray(b.column("n").to_pylist(), float)
        p = model.posterior(votes)
        return np.vstack([np.append(n @ (1 - p), (n * (1 - p)) @ votes), np.append(n @ p, (n * p) @ votes)])

    share = _shares(patterns, model, width)
    for _ in range(rounds):
        model.share = share
        clean, toxic = matrix_sum(patterns, (2, width + 1), expected)
        if clean[0] + toxic[0] == 0:
            break
        weight = min(1.0, (n0 + n1) / (clean[0] + toxic[0])) if n0 and n1 else 1.0
        clean, toxic = weight * clean, weight * toxic
        n, t = clean[0] + toxic[0] + n0 + n1, toxic[0] + n1
        model = LabelModel(min(0.9, max(1e-3, (t + 1) / (n + 2))), rates(toxic[1:] + f1, t), rates(clean[1:] + f0, n - t), silent)
    model.share = share
    return model


def _shares(patterns: DataFrame, model: LabelModel, width: int) -> np.ndarray:
    """Weight left to each voter: one over one plus its residual correlations, given the label, with those that repeat it."""
    def second(b):
        votes, n = stack(b.column("votes"), width), np.asarray(b.column("n").to_pylist(), float)
        p = model.posterior(votes)
        out = []
        for w, rate in ((n * (1 - p), model.clean), (n * p, model.toxic)):
            r = votes - rate
            out.append((r * w[:, None]).T @ r)
        return np.vstack(out)

    moments = matrix_sum(patterns, (2 * width, width), second)
    repeated = moments[width:]  # among texts held toxic: clean ones hardly fire a voter
    d = np.sqrt(np.maximum(np.diag(repeated), 1e-9))
    repeated = np.clip(repeated / np.outer(d, d), 0, 1)
    np.fill_diagonal(repeated, 0)
    return 1 / (1 + np.where(repeated > 0.8, repeated, 0).sum(1))


def _inputs(hits: np.ndarray) -> np.ndarray:
    """Classifier inputs: whether and how densely each voter fires, and a constant."""
    n = np.maximum(hits[:, -1:], 1)
    votes = hits[:, :-1]
    return np.hstack([(votes > 0).astype(float), np.log1p(votes), np.sqrt(votes / n), np.ones((len(hits), 1))])


def fit_classifier(rows: DataFrame, width: int, label_model: LabelModel, penalty: float = 1.0, steps: int = NEWTON) -> np.ndarray:
    """Logistic regression on the posterior label of each row (hits), by Newton steps on partition sums.

    Given labels fix the label model; the classifier sees what that says of every row, labelled or not.
    """
    size = 3 * width + 1
    w = np.zeros(size)
    ridge = np.full(size, penalty)
    ridge[-1] = 1e-6
    for _ in range(steps):
        def step(b, w=w):
            hits = stack(b.column("hits"), width + 1)
            x, y = _inputs(hits), label_model.posterior((hits[:, :-1] > 0).astype(float))
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            return np.vstack([(x * (p * (1 - p) + 1e-6)[:, None]).T @ x, x.T @ (y - p)])
        sums = matrix_sum(rows, (size + 1, size), step)
        change = np.linalg.solve(sums[:size] + np.diag(ridge), sums[size] - ridge * w)
        w = w + change
        if np.abs(change).max() < 1e-3:
            break
    return w


def toxicity_scores(docs: DataFrame, labels: DataFrame, held_out: int = HELD_OUT, remainder: int = HELD_REMAINDER,
                    cut: float = 0.7) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted.

    Equal texts have equal scores. A text is read whole, by one task, whose memory grows with it.

    Only rows whose id remainder modulo ``held_out`` is not ``remainder`` teach.
    Null text is empty, fires no voter and gets the lowest score; null labels and
    ids teach nothing; a repeated label counts again; without labels the fixed
    voters work alone. Extra columns are ignored; an empty table gives no rows.
    """
    return _scored(docs, labels, held_out, remainder, cut).drop("mark")


def _scored(docs: DataFrame, labels: DataFrame, held_out: int = HELD_OUT, remainder: int = HELD_REMAINDER, cut: float = 0.7) -> DataFrame:
    """``toxicity_scores`` with the mark of each row's text."""
    texts = doc_bytes(docs, id_remainder(held_out).cast("int").alias("remainder"), text_mark())
    marked = labels.filter("toxic IS NOT NULL").select(F.col("doc_id").cast("long").alias("_id"), F.col("toxic").cast("int").alias("label"))
    teaching = marked.filter(id_remainder(held_out, "_id") != remainder)
    voters = Voters(mined_units(texts, teaching))
    run, width = _votes(voters)
    rows = stored(texts.mapInArrow(run, "doc_id long, remainder int, mark long, hits binary"), "toxicity-votes")
    training = stored(rows.filter(F.col("remainder") != remainder).join(marked, F.col("doc_id") == F.col("_id"), "left")
                      .select("hits", "label"), "toxicity-training")

    def firings(b):
        hits, y = stack(b.column("hits"), width + 1), np.asarray(b.column("label").to_pylist(), float)
        fired = (hits[:, :-1] > 0).astype(float)
        none = ~fired.any(1)
        return np.vstack([[(1 - y).sum(), *((1 - y) @ fired), (1 - y) @ none], [y.sum(), *(y @ fired), y @ none]])

    def patterns_of(batches):
        for b in batches:
            hits = stack(b.column("hits"), width + 1)
            votes, n = np.unique(hits[:, :-1] > 0, axis=0, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array([v.tobytes() for v in votes.astype(float)], pa.binary()), pa.array(n, pa.int64())],
                                             names=["votes", "n"])

    seen = matrix_sum(training.filter("label IS NOT NULL"), (2, width + 2), firings)
    patterns = stored(training.mapInArrow(patterns_of, "votes binary, n long").groupBy("votes").agg(F.sum("n").alias("n")), "toxicity-patterns")
    label_model = fit_label_model(patterns, seen, width)
    weights = fit_classifier(training, width, label_model)

    def score(batches):
        for b in batches:
            s = 1 / (1 + np.exp(-np.clip(_inputs(stack(b.column("hits"), width + 1)) @ weights, -30, 30)))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([r == remainder for r in b.column("remainder").to_pylist()], pa.bool_()),
                                              pa.array(s, pa.float64()), pa.array((s >= cut).astype(np.int32), pa.int32()), b.column("mark")],
                                             names=["doc_id", "held_out", "score", "predicted", "mark"])
    return rows.mapInArrow(score, "doc_id long, held_out boolean, score double, predicted int, mark long")


def drop_toxic(docs: DataFrame, labels: DataFrame, cut: float = 0.7) -> DataFrame:
    """The rows of ``docs`` not predicted toxic, with all their columns; each row by its own text, whatever its id."""
    return without(docs, _scored(docs, labels, cut=cut).filter("predicted = 1"))
