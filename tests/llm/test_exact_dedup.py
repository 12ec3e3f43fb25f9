import hashlib
import random
from collections import defaultdict

import pytest

from stratamart.llm import exact_dedup as X


def low(t):
    return (t or "").encode().lower()


def test_messy_rows_against_brute_force(messy, messy_rows):
    groups = defaultdict(list)
    for r in messy_rows:
        groups[low(r[1])].append(r[0])
    want = []
    for r in messy_rows:
        ids = [i for i in groups[low(r[1])] if i is not None]
        keep = max(ids) if ids else None
        want.append((r[0], keep, len(groups[low(r[1])]), r[0] == keep, hashlib.sha256(low(r[1])).hexdigest()))
    key = lambda x: (x[4], x[0] is None, x[0] or 0)
    assert sorted(map(tuple, X.exact_duplicates(messy).collect()), key=key) == sorted(want, key=key)


def test_only_ascii_letters_are_folded(spark):
    df = spark.createDataFrame([(1, "Éa"), (2, "éa"), (3, "ÉA")], "doc_id long, text string")
    assert {r["doc_id"]: r["keep_id"] for r in X.exact_duplicates(df).collect()} == {1: 3, 2: 2, 3: 3}


def test_smallest_owner_and_kept_rows(messy, messy_rows):
    assert {r["keep_id"] for r in X.exact_duplicates(messy, keep="smallest").filter("doc_id IN (1, 2)").collect()} == {1}
    stay = X.drop_exact_duplicates(messy)
    assert stay.columns == messy.columns
    ids = [r["doc_id"] for r in stay.select("doc_id").collect()]
    assert 1 not in ids and ids.count(4) == 2 and ids.count(None) == 0 and 2 in ids


def test_rows_with_shared_or_missing_ids_are_told_apart(spark):
    rows = [(1, "aaa"), (1, "bbb"), (2, "aaa"), (None, "dup"), (None, "dup"), (3, "dup"), (None, "alone")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert sorted(map(tuple, X.drop_exact_duplicates(df).collect()), key=str) == sorted([(1, "bbb"), (2, "aaa"), (3, "dup"), (None, "alone")], key=str)


@pytest.mark.parametrize("budget", [1_000, 10**9])
def test_one_trie_for_all_texts_of_a_partition(spark, monkeypatch, small_docs, budget):
    spills, tries = [], []
    spill, init = X.PatriciaTrie._spill, X.PatriciaTrie.__init__
    monkeypatch.setattr(X.PatriciaTrie, "_spill", lambda self, byte: (spills.append(byte), spill(self, byte)))
    monkeypatch.setattr(X.PatriciaTrie, "__init__", lambda self, *a: (tries.append(1), init(self, *a))[1])
    import pyarrow as pa
    texts = [low(t) for _, t in small_docs]
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.binary()), pa.array([d for d, _ in small_docs], pa.int64()),
                                        pa.array([1] * len(texts), pa.int64())], names=["text", "owner", "copies"])
    out = [r for b in X._owners_of_partition(X._merge_largest, budget)(iter([batch])) for r in b.to_pylist()]
    assert len(out) == len(set(texts)) and bool(spills) == (budget < 10**9) and (len(tries) == 1) == (budget == 10**9)
    assert {r["digest"]: r["copies"] for r in out} == {hashlib.sha256(t).digest(): texts.count(t) for t in set(texts)}
    owners = X.text_owners(spark.createDataFrame(small_docs, "doc_id long, text string"), trie_bytes=budget)
    assert sorted((r["owner"], r["copies"]) for r in owners.collect()) == sorted((r["owner"], r["copies"]) for r in out)


def test_empty_table(empty):
    assert X.exact_duplicates(empty).count() == 0 and X.drop_exact_duplicates(empty).count() == 0


@pytest.mark.parametrize("budget", [20, 200, 10**9])
def test_trie_with_spilled_subtrees(budget):
    rnd = random.Random(budget)
    strings = [bytes(rnd.choice(b"ab") for _ in range(rnd.randint(0, 12))) for _ in range(400)]
    trie = X.PatriciaTrie(lambda a, b: a + b, budget)
    want = defaultdict(int)
    for s in strings:
        trie.insert(s, 1)
        want[s] += 1
    assert bool(trie.spilled) == (budget < 10**9)
    got = list(trie.items())
    assert len(got) == len(want) and dict(got) == want
