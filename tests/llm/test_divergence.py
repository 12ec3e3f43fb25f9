"""Divergences against a one-process version; the whole table is checked by SQL in test_queries."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from stratamart.llm import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def brute(rows, least):
    count, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for lang, source, text in rows:
        terms = [re.sub("[A-Z]+", lambda m: m[0].lower(), t) for t in TERM.findall(text or "")]
        group = lang or "", source or ""
        groups.add(group)
        count[group].update(terms)
        docs[group[0]].update(set(terms))
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in docs[lang].items() if n >= least]
        sources = [g[1] for g in groups if g[0] == lang]

        def shares(c):
            total = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 2) // (total + 2 * len(kept)) for t in kept}
        p = {s: shares(count[lang, s]) for s in sources}
        q = shares(sum((count[lang, s] for s in sources), Counter()))
        for s in sources:
            pairs = [(x, sum((p[s][t] - p[x][t])**2 // (p[s][t] + p[x][t]) for t in kept)) for x in sources if x != s]
            terms = [(t, (p[s][t] - q[t])**2 // (p[s][t] + q[t])) for t in kept if count[lang, s][t] and p[s][t] > q[t]]
            for part, items, top in (("pair", pairs, None), ("term", terms, 10)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, x, v, k + 1) for k, (x, v) in enumerate(items[:top])]
    return sorted(out)


def rows_of(df):
    return sorted(tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect())


@pytest.mark.parametrize("blocks", [(64, None), (2, 7), (1, 1)])
def test_against_definition(spark, sf_dir, blocks):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").filter("lang in ('de', 'fr')")
    rows = [(r["lang"], r["source"], r["text"]) for r in docs.collect()]
    got = rows_of(divergence.audit(docs, least_docs=4, group_block=blocks[0], blocks=blocks[1]))
    assert got == brute(rows, 4) and {r[2] for r in got} == {"pair", "term"}


@pytest.mark.parametrize("least", [1, 3, 1000])
def test_messy(spark, messy, messy_rows, empty, least):
    got = rows_of(divergence.audit(messy, least_docs=least, group_block=2, blocks=3))
    assert got == brute([(r[2], r[3], r[1]) for r in messy_rows], least)
    assert divergence.audit(empty).count() == 0


def test_counts_flush_when_full(spark, messy):
    one = sorted(map(str, divergence.term_blocks(messy, 1, 3).collect()))
    assert one == sorted(map(str, divergence.term_blocks(messy, 1, 3, held=3).collect()))


def test_probability_beyond_long():
    n, total, v = 9 * 10**17, 10**18, 10**6
    assert divergence.probabilities(np.array([n]), total, v)[0] == 1 + 10**9 * (n + 2) // (total + 2 * v)
    assert divergence.probabilities(np.array([3]), 10, 4)[0] == 1 + 10**9 * 5 // 18
