import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clinspark.llm import chat

PARTS = st.sampled_from(["\\", "###", "</turn>", "\n", " ", "Assistant: ", "#", "<", "/turn>", "ok", "é", "### Assistant: ", "\n</turn>\n"])
TEXTS = st.lists(PARTS, max_size=12).map("".join)


@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "tool", "", "System", "a: b\n", "é</turn>"]), TEXTS), max_size=6))
@settings(max_examples=400, deadline=None)
def test_round_trip(turns):
    t = chat.Template()
    whole = "".join(chat.rendered(role, text, t)[0] for role, text in turns)
    assert [x[:2] for x in t.parse(whole)] == turns
    # outside the template's own marks every control string has a backslash before it
    for _, _, a, b in t.parse(whole):
        assert not t.conflicts(whole[a:b])


def test_a_template_that_cannot_be_read_back_raises():
    with pytest.raises(chat.FormatError):
        chat.rendered("user", "text", chat.Template(end="</end"  "\n", head="{}> "))


def by_hand(rows):
    out, convs = [], {}
    for r in rows:
        convs.setdefault(r.conv_id, []).append((r.turn is None, r.turn or 0, r.role or "", r.text or ""))
    for conv, turns in convs.items():
        turns.sort()
        said = "".join(f"{role}\n{text}\n" for _, _, role, text in turns)
        loss = "".join(text for _, _, role, text in turns if role == "assistant")
        out.append((conv, len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()))
    return sorted(out, key=str)


def digests(formatted):
    rows = chat.read_back(formatted).collect()
    return sorted(((r.conv_id, r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in rows), key=str)


@pytest.mark.parametrize("part", [1, 500, chat.PART])
def test_conversations(spark, part):
    turns = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    formatted = chat.format_conversations(turns, part).cache()
    assert digests(formatted) == by_hand(turns.collect())
    chars = {r.conv_id: r.formatted_chars for r in chat.read_back(formatted).collect()}
    assert chars == {r.conv_id: r.n for r in formatted.groupBy("conv_id").agg(F.sum(F.length("formatted")).alias("n")).collect()}


def test_odd_conversations(spark):
    sample = "\\### Assistant: </turn> ok"
    rows = [(1, 0, "user", sample), (1, 1, "assistant", sample), (1, 1, "assistant", sample), (1, None, None, None), (None, 0, "assistant", "a"),
            (None, 0, "assistant", ""), (2, 5, "assistant", "\n</turn>\n### User: x"), (2, 3, "", "long " * 300_000), (3, 0, "tool", None)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns(
        {c: F.lit(c) for c in ("part", "formatted", "mask")})
    assert digests(chat.format_conversations(turns)) == by_hand(turns.collect())


def test_no_conversations(spark):
    turns = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert digests(chat.format_conversations(turns)) == []
