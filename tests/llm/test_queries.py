"""Registered queries against their SQL, and the pipeline against what its stages promise."""

import pytest
from check_oracles import compare, duck

import __spark_entry__ as entry_points
import corpus_pipeline
from stratamart.llm import decontaminate
from stratamart.llm import queries as Q
from test_near_dedup import brute


def test_all_are_registered():
    names = entry_points.queries()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)) and "pipeline" in names
    assert set(Q.ORACLES) <= set(Q.QUERIES)


@pytest.mark.parametrize("name", list(Q.ORACLES))
def test_against_sql(spark, sf_dir, name):
    assert compare(Q.QUERIES[name](spark, sf_dir), duck(sf_dir), Q.ORACLES[name]) is None


@pytest.mark.parametrize("name", list(Q.QUERIES))
def test_no_cross_product(spark, sf_dir, name):
    plan = Q.QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_pipeline(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    state = {r["doc_id"]: r for r in docs.collect()}
    labels = {r["doc_id"]: r for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    items = [" ".join(decontaminate.words_of(r["text"])) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    now, kept = docs, dict(state)
    for name, stage in corpus_pipeline.STAGES:
        now = corpus_pipeline.stored(stage(spark, now, sf_dir), name)
        ids = {r["doc_id"] for r in now.select("doc_id").collect()}
        gone = {i: r for i, r in kept.items() if i not in ids}
        if name != "mixing":
            assert sorted(now.columns) == sorted(docs.columns)
        if name == "toxicity":
            assert all(labels[i]["toxic"] == 1 for i in gone if i in labels) and gone
        elif name == "exact_dedup":
            low = lambda r: r["text"].encode().lower()
            best = {}
            for i, r in kept.items():
                best[low(r)] = max(i, best.get(low(r), i))
            assert ids == set(best.values())
        elif name == "near_dedup":
            rows = [(i, r["text"]) for i, r in kept.items()]
            assert ids == {d for d, _, c in brute(rows, 5) if d == c}
        elif name == "decontamination":
            holds = {i for i, r in kept.items() if any(f" {t} " in f" {' '.join(decontaminate.words_of(r['text']))} " for t in items)}
            assert set(gone) == holds
        else:
            assert all(0 < r["taken"] <= 2 * r["size"] for r in now.collect())
        kept = {i: r for i, r in kept.items() if i in ids}
    assert kept


def test_pipeline_run_on_messy_rows(spark, messy, empty, sf_dir):
    """Each stage drops the rows its rule names, also of those without an id or with one that others have, and no other."""
    low = lambda t: (t or "").encode().lower()
    now = messy
    for name, stage in corpus_pipeline.STAGES:
        before = [(r["doc_id"], r["text"]) for r in now.collect()]
        now = corpus_pipeline.stored(stage(spark, now, sf_dir), name)
        after = [(r["doc_id"], r["text"]) for r in now.collect()]
        if name == "exact_dedup":
            largest = {}
            for i, t in before:
                largest[low(t)] = max((x for x in (i, largest.get(low(t))) if x is not None), default=None)
            want = [(i, t) for i, t in before if i == largest[low(t)]]
        elif name == "near_dedup":
            want = [row for row, (i, _, c) in zip(before, brute(before, 5)) if i == c]
        elif name == "decontamination":
            want = before
        else:
            assert set(after) <= set(before) and after
            continue
        assert sorted(after, key=str) == sorted(want, key=str)
    assert all(0 < r["taken"] <= 2 * r["size"] * sum(x == (r["doc_id"], r["text"]) for x in after) for r in now.collect())
    for name, stage in corpus_pipeline.STAGES:
        empty = corpus_pipeline.stored(stage(spark, empty, sf_dir), name)
    assert empty.count() == 0
