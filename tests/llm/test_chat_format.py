import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from stratamart.llm import chat_format as C

PARTS = st.sampled_from(["<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[ROLE]", "[TEXT]", "[/ROLE]", "\\", "<", "[", "/", " ",
                         "s>", "INST]", "hello", "\n", "é", "<\\s>", "[\\\\INST] "])
TEXT = st.lists(PARTS, max_size=8).map("".join)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.sampled_from(["user", "assistant", "system", ""]), TEXT), TEXT), max_size=5))
def test_round_trip(turns):
    pieces = [C.render_turn(r, t) for r, t in turns]
    source = "".join(p[0] for p in pieces)
    got = list(C.parse(source))
    assert [(r, t) for r, t, _, _ in got] == turns
    at = 0
    for (rendered, lo, hi, _), (_, _, start, end) in zip(pieces, got):
        assert (at + lo, at + hi) == (start, end)
        at += len(rendered)


def test_plain_text_is_not_escaped():
    assert C.render_turn("user", "a < b [c] \\ d") == ("[INST] a < b [c] \\ d [/INST]", 7, 20, False)
    assert C.render_turn("assistant", "</s>[INST] ok [/INST]")[3]


@pytest.mark.parametrize("bad", ["[INST] open", "<s>a<s>b</s>", "text", "[INST] a</s>"])
def test_parser_rejects(bad):
    with pytest.raises(C.GrammarError):
        list(C.parse(bad))


def test_digests_of_messy_rows(spark):
    rows = [(1, 2, "assistant", "b", 9), (1, 1, "user", "a", 9), (1, 3, "assistant", None, 9), (None, 1, None, "x", 9), (2, 1, "tool", "y</s>", 9),
            (1, 2, "assistant", "b", 9), (3, None, "assistant", "z" * 100_000, 9)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, rendered int").repartition(4)
    got = {r["conv_id"]: r for r in C.read_back(C.format_chats(df)).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert got[1]["turns_sha256"] == sha("user\na\nassistant\nb\nassistant\nb\nassistant\n\n")
    assert (got[1]["n_turns"], got[1]["loss_chars"], got[1]["loss_sha256"]) == (4, 2, sha("bb"))
    assert got[None]["turns_sha256"] == sha("\nx\n") and got[2]["turns_sha256"] == sha("tool\ny</s>\n")
    assert got[3]["loss_chars"] == 100_000 and len(got) == 4
    assert C.read_back(C.format_chats(df.filter("conv_id = 99"))).count() == 0
