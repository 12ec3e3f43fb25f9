from collections import defaultdict

import pytest

from stratamart.llm import mixing as M


def targets(sizes):
    """Shares by weight; what is over a cap is shared out again until nothing is."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    out, free, left = {}, set(names), 1.5 * sum(sizes.values())
    while free:
        total = sum(weight[s] for s in free)
        over = {s for s in free if left * weight[s] / total > 2 * sizes[s]}
        if not over:
            out.update({s: left * weight[s] / total for s in free})
            break
        for s in over:
            out[s] = 2.0 * sizes[s]
        left -= sum(out[s] for s in over)
        free -= over
    return out


def check(rows, tolerance):
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in rows:
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
    want = targets(sizes)
    for r in rows:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
        assert 0 <= r["taken"] <= 2 * r["size"]
    for s in sizes:
        assert abs(taken[s] - want[s]) <= tolerance


def test_given_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    first = M.mix(docs).collect()
    assert sorted(first) == sorted(M.mix(docs).collect()) and len(first) == docs.count()
    check(first, 4 * M.SLOT_WORDS)
    words = {r["doc_id"]: len(r["text"].encode().split()) for r in docs.collect()}
    assert {r["doc_id"]: r["size"] for r in first} == words


def test_messy_and_empty(messy, messy_rows, empty):
    rows = M.mix(messy).collect()
    assert len(rows) == len(messy_rows)
    check(rows, 200)
    mixed = M.mixed(messy)
    assert mixed.columns == [*messy.columns, "size", "source_size", "target", "taken"]
    assert M.mix(empty).count() == 0 and M.mixed(empty).count() == 0
    own = messy.withColumn("taken", M.F.lit("mine"))
    assert M.mixed(own).columns.count("taken") == 1


def test_schedule_is_even(spark):
    rows = [(0, "a", 10_000, 15_000.0), (1, "b", 40_000, 30_000.0), (2, "c", 20_000, 30_000.0)]
    df = M.schedule(spark.createDataFrame(rows, "number long, source string, source_size long, target double"), slot_words=10)
    slots = {r["slot"]: r for r in df.collect()}
    assert len(slots) == 7500
    seen = defaultdict(int)
    for i in range(7500):
        r = slots[i]
        assert r["rank"] == seen[r["number"]] and r["block"] == r["rank"] % (rows[r["number"]][2] // 10)
        seen[r["number"]] += 1
        for n, _, _, target in rows:  # at every moment each source has had its share
            assert abs(seen[n] - (i + 1) * target / 75_000) <= 5


def test_hot_source_and_long_document(spark):
    rows = [(i, "word " * (i % 7), "hot") for i in range(3000)] + [(5000 + i, "w " * 50, f"s{i % 4}") for i in range(100)] + [(9999, "z " * 40_000, "s1")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    check(M.mix(df).collect(), 4 * M.SLOT_WORDS)


def test_reruns_agree_for_repeated_and_missing_ids(spark):
    import random
    rnd = random.Random(6)
    rows = [(rnd.choice([1, 2, 3, None]), " ".join(["w"] * rnd.randint(1, 40)) + f" {i % 150}", f"s{i % 4}") for i in range(400)]
    out = []
    for parts in (3, 7):
        df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(parts)
        out.append((sorted(map(str, M.mix(df, slot_words=16).collect())), sorted(map(str, M.mixed(df, slot_words=16).collect()))))
    assert out[0] == out[1]


def test_taken_words_against_one_process(spark, small_docs):
    """Blocks, ranks and uses counted by a plain loop over the shuffled streams."""
    from pyspark.sql import functions as F
    slot = 64
    df = spark.createDataFrame([(i, t, f"s{i % 5}") for i, t in small_docs], "doc_id long, text string, source string")
    keyed = df.select("doc_id", "source", F.xxhash64(F.lit("shuffle"), F.col("doc_id"), F.xxhash64(F.coalesce("text", F.lit("")))).alias("key"),
                      M.word_count("text").alias("size"))
    rows = sorted((r for r in keyed.collect() if r["size"]), key=lambda r: (r["key"], r["doc_id"]))
    got = M.mix(df, slot_words=slot).collect()
    target = {r["source"]: r["target"] for r in got}
    size = {r["source"]: r["source_size"] for r in got}
    names, words = sorted(target), sum(target[s] for s in sorted(target))
    ends, total = [], 0.0
    for s in names:
        total += target[s]
        ends.append(round(total / words * M.RING))
    uses = {s: [0] * -(-size[s] // slot) for s in names}
    rank = dict.fromkeys(names, 0)
    for k in range(-(-round(words) // slot)):
        point = (k % M.RING) * M.GOLDEN % M.RING
        s = next(n for n, e in zip(names, ends) if point < e)
        if rank[s] < 2 * len(uses[s]):
            uses[s][rank[s] % len(uses[s])] += 1
        rank[s] += 1
    want, at = {}, dict.fromkeys(names, 0)
    for r in rows:
        s, lo = r["source"], at[r["source"]]
        hi = at[s] = lo + r["size"]
        want[r["doc_id"]] = sum((min(hi, (b + 1) * slot) - max(lo, b * slot)) * uses[s][b] for b in range(lo // slot, (hi - 1) // slot + 1))
    assert {r["doc_id"]: r["taken"] for r in got if r["size"]} == want
