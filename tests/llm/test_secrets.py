import hashlib
import random
import re

from stratamart.llm import secrets as S


def base(text):
    """The base spans as their definition reads."""
    out = []
    for kind, pattern, group, least in ((0, r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
                                        (1, r"AKIA[A-Z0-9]+", 0, 20), (2, r"[0-9a-f]+", 0, 24)):
        out += [(m.start(), kind, m.end()) for m in re.finditer(pattern, text) if len(m[group]) >= least]
    return ",".join(f"{S.KINDS[k]}:{s}:{e}" for s, k, e in sorted(out))


def corpus():
    rnd = random.Random(3)
    secret = lambda: "".join(rnd.choice("0123456789abcdef") for _ in range(40))
    bits = ["token = \"%s\"", "PassWord:%s", "é api_key=%s.", "secret='ab'", "secret=token:abcdefgh", "AKIA%s", "plain words here", "passwd = short",
            "toKen=ſecret=abcdef"]
    texts = [" ".join((b % secret() if "%s" in b else b) for b in rnd.sample(bits, 4)) for _ in range(60)]
    texts += ["key AKIA" + "A1B2" * 5, "", None, "order 1234567890123456 of 2024-01-01T00-00-00"] + [f"order {rnd.randint(10**15, 10**16)}" for _ in range(40)]
    return texts


def test_base_spans_are_the_definition(spark):
    rows = list(enumerate(corpus()))
    got = {r["doc_id"]: r for r in S.scan_secrets(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    assert len(got) == len(rows)
    for i, t in rows:
        want = base(t or "")
        assert got[i]["base_sha256"] == hashlib.sha256(want.encode()).hexdigest()
        assert set(filter(None, want.split(","))) <= set(got[i]["spans"].split(","))
        assert got[i]["n_hex"] == want.count("hex:")


def test_unmarked_credentials_are_added_and_numbers_are_not(spark):
    rnd = random.Random(8)
    key = lambda: "".join(rnd.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789") for _ in range(32))
    bare = f"x{key()}9"[:32]
    rows = list(enumerate(corpus())) + [(500 + i, f"token = {key()}") for i in range(150)]
    rows += [(1000, f"see {bare} there"), (1001, "call 5555444433332222 now")]
    got = {r["doc_id"]: r for r in S.scan_secrets(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1001]["n_learned"] == 0 and got[1001]["spans"] == ""
    assert got[1000]["spans"] == "learned:4:36"


def test_automaton_generalises_a_format():
    rnd = random.Random(1)
    make = lambda: "".join(rnd.choice("0123456789abcdef") for _ in range(40))
    learned = S.learn_automaton([make() for _ in range(300)])
    words = S.learn_automaton(["".join(rnd.choice("qwertyuiopghjkl") for _ in range(20)) + "9" for _ in range(300)])
    assert len(learned.states) < 300
    new, word = make(), "".join(rnd.choice("qwertyuiop") for _ in range(20)) + "9"
    assert learned.log_likelihood(new) - words.log_likelihood(new) > S.MARGIN
    assert learned.log_likelihood(word) - words.log_likelihood(word) < 0


def test_all_candidates_are_scored(spark):
    """Letters alone, a digit far in, and fewer than sixteen characters: each is a candidate and, being like the labelled ones, a span."""
    rnd = random.Random(5)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
    make = lambda n, chars: "".join(rnd.choice(chars) for _ in range(n))
    words = ["".join(rnd.choice("eaintrsolh") for _ in range(rnd.randint(6, 11))) for _ in range(400)]
    rows = [(i, " ".join(rnd.choice(words) for _ in range(40)) + f" token = {make(rnd.choice((15, 36, 70)), letters + '0123456789')}") for i in range(200)]
    own = [make(36, letters), make(68, letters) + "7" + make(3, letters), make(15, letters + "0123456789")]
    rows += [(1000 + i, f"see {x} there") for i, x in enumerate(own)] + [(2000, " ".join(words))]
    got = {r["doc_id"]: r for r in S.scan_secrets(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, x in enumerate(own):
        assert got[1000 + i]["spans"] == f"learned:4:{4 + len(x)}"
    assert got[2000]["n_learned"] == 0


def test_learned_spans_against_one_process(spark):
    """Samples, automata and spans as a plain loop over all texts gives them."""
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").repartition(5)
    small_docs = [tuple(r) for r in df.collect()]
    labelled, ordinary, found = set(), set(), {}
    for i, t in small_docs:
        base = S.base_spans(t or "")
        labelled |= {x[3] for x in base}
        found[i] = [m for m in re.finditer(r"[A-Za-z0-9+/_=-]{6,}", t or "") if not any(m.start() < e and s < m.end() for s, e, _, _ in base)]
        ordinary |= {m[0] for m in found[i]}
    pick = lambda values: [v for _, v in S._least(values, 100)]
    assert S.samples(df, 100) == (pick(labelled), pick(ordinary))
    a, b = S.learn_automaton(pick(labelled)), S.learn_automaton(pick(ordinary))
    least = min(a.log_likelihood(v) / (len(v) + 1) for v in pick(labelled))
    like = lambda v: a.log_likelihood(v) >= least * (len(v) + 1) and a.log_likelihood(v) - b.log_likelihood(v) >= S.MARGIN
    for r in S.scan_secrets(df, sample=100).collect():
        want = [f"learned:{m.start()}:{m.end()}" for m in found[r["doc_id"]] if like(m[0])]
        assert [x for x in r["spans"].split(",") if x.startswith("learned")] == want and r["n_learned"] == len(want)


def test_messy_and_empty(messy, empty, messy_rows):
    assert S.scan_secrets(messy).count() == len(messy_rows) and S.scan_secrets(empty).count() == 0
