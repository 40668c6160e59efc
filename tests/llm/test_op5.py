"""Chat formatting: the round trip, by hand-picked and by random texts."""

import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from freshet.llm import op5_chat as op

PIECES = ["### ", "###", "#", "</turn>", "</turn", "<", "\\", ": ", ":", "\n", "assistant", "a", "é", "\U0001f600", " ", "\\### Assistant: </turn> ok"]
tricky = st.lists(st.sampled_from(PIECES), max_size=12).map("".join) | st.text(max_size=20)


@settings(max_examples=600, deadline=None)
@given(st.lists(st.tuples(tricky, tricky), max_size=4))
def test_conversations_come_back(turns):
    made = [op.render(r, b) for r, b in turns]
    text = "".join(m[0] for m in made)
    assert [t[:2] for t in op.parse(text)] == turns
    for (_, body), (out, lo, hi, _) in zip(turns, made, strict=True):
        assert op.plain(out[lo:hi]) == body


def test_only_conflicting_content_is_escaped():
    assert op.render("user", "a # b < c \\d : e")[3] == 0
    assert op.render("user", "a </turn> b") == ("### user: a \\</turn> b</turn>\n", 10, 22, 1)
    assert op.render("user", op.PROBE_TEXT)[3] == 2 and op.render("user", "ends with \\")[3] == 2


@pytest.mark.parametrize("text", ["x", "### user: a", "### user: a</turn>", "### user: a</turn>\nx", "### user: ### b</turn>\n", "### us### er: a</turn>\n"])
def test_parser_refuses_what_is_no_conversation(text):
    with pytest.raises(ValueError):
        op.parse(text)


def expected(rows):
    """Digest by conversation; rows (conv_id, turn, role, text)."""
    out = {}
    for c, _, r, t in sorted(rows, key=lambda x: (x[1] is not None, x[1] or 0)):
        out.setdefault(c, []).append((r or "", t or ""))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return {c: (len(v), sha("".join(f"{r}\n{t}\n" for r, t in v)), sum(len(t) for r, t in v if r == "assistant"), sha("".join(t for r, t in v if r == "assistant"))) for c, v in out.items()}


def test_edge_rows(spark):
    rows = [(1, 2, "user", None), (1, 1, None, "x: y"), (1, 3, "assistant", ""), (1, None, "assistant", "first"), (2, 0, "assistant: a", "</turn>\n### user: "),
            (None, 0, "assistant", "lost"), (3, 0, "assistant", "long \\" * 200_000), (4, 0, "user", "twice"), (4, 0, "user", "twice")]
    rows += [(9, i, "assistant" if i % 2 else "user", f"turn {i} ### ") for i in range(25_000)]  # one hot conversation over many batches
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("rendered", F.lit("clash"))
    got = {r[0]: tuple(r)[1:5] for r in op.read_back(op.format_turns(df)).collect()}
    assert got == expected(rows)
    assert op.read_back(op.format_turns(df.limit(0))).count() == 0


def test_given_conversations(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows += [(-7, 0, "user", op.PROBE_TEXT), (-7, 1, "assistant", op.PROBE_TEXT)]
    got = op.op5_chat(spark, sf).collect()
    assert {r[0]: tuple(r)[1:5] for r in got} == expected(rows)
    made = op.format_turns(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    lengths = {r[0]: r[1] for r in made.groupBy("conv_id").agg(F.sum(F.char_length("rendered"))).collect()}
    assert {r["conv_id"]: r["formatted_chars"] for r in got} == lengths
