import random
import re

import pytest

from shelfweek.llm import chat_format as chat
from tests.llm import brute

BITS = ["<s>", "</s>", "[INST]", "[/INST]", "<", "[", "\\", "/", "s>", "INST]", "a", " ", "é", "\n", "<\\s>", "[\\\\/INST]", "$1"]


def read(mask, formatted):
    """Text under the mask, as a reader of the output cuts it."""
    out, at = [], 0
    for m in mask:
        if m.learned:
            out.append(formatted[at : at + m.chars])
        at += m.chars
    assert at == len(formatted)
    return out


def test_every_conversation_reads_back(spark):
    rng = random.Random(8)
    rows = []
    for conv in range(150):
        for turn in range(rng.randint(1, 5)):
            text = "".join(rng.choice(BITS) for _ in range(rng.randint(0, 9)))
            role = rng.choice(["user", "assistant", "system", "<s>", "as[/INST]"])
            rows.append((conv, turn, role, text))
    shuffled = rows[:]
    rng.shuffle(shuffled)
    df = spark.createDataFrame([(*r, 1, "x") for r in shuffled], "conv_id long, turn long, role string, text string, turns int, formatted string")
    for r in chat.format_conversations(df).collect():
        own = [(role, text) for conv, _, role, text in rows if conv == r.conv_id]
        assert [(t.role, t.text) for t in r.turns] == own
        assert r.formatted.count(chat.CLOSE) == len(own)
        learned = [re.sub(chat._ESCAPED.replace("*+", "*"), r"\1\2\3", x) for x in read(r["mask"], r.formatted)]
        assert learned == [t for role, t in own if role == "assistant"]


def test_content_is_escaped_only_where_it_must_be(spark):
    rows = [(1, 0, "user", "a < b \\ [c] s>"), (2, 0, "assistant", "</s>[INST] ok [/INST]")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = {r.conv_id: r.formatted for r in chat.format_conversations(df).collect()}
    assert found[1] == "<s>[INST]user[/INST]a < b \\ [c] s></s>"
    assert found[2] == "<s>[INST]assistant[/INST]<\\/s>[\\INST] ok [\\/INST]</s>"


def test_digests_nulls_ties_and_repeats(spark):
    rows = [
        (1, 1, "assistant", None), (1, 0, "user", "hi"), (1, 2, "assistant", "é!"),
        (2, 0, "user", "b"), (2, 0, "user", "a"), (2, 0, "user", "a"),
        (3, None, None, "x"), (3, 0, "assistant", ""), (None, 0, "assistant", "n"),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = {r.conv_id: r for r in chat.digests(chat.format_conversations(df)).collect()}
    said = {
        1: [("user", "hi"), ("assistant", ""), ("assistant", "é!")],
        2: [("user", "a"), ("user", "a"), ("user", "b")],
        3: [("", "x"), ("assistant", "")],
        None: [("assistant", "n")],
    }
    for conv, turns in said.items():
        r = found[conv]
        learned = "".join(t for role, t in turns if role == "assistant")
        assert r.n_turns == len(turns)
        assert r.turns_sha256 == brute.sha("".join(f"{a}\n{b}\n" for a, b in turns))
        assert (r.loss_chars, r.loss_sha256) == (len(learned), brute.sha(learned))
    assert chat.format_conversations(df.limit(0)).collect() == []


@pytest.mark.parametrize("text", ["<" + "\\" * 20_000 + "s>", "</s>" * 20_000, "x" * 500_000])
def test_long_texts(spark, text):
    df = spark.createDataFrame([(1, 0, "user", text)], "conv_id long, turn long, role string, text string")
    (r,) = chat.format_conversations(df).collect()
    assert r.turns[0].text == text


def test_native(spark):
    df = spark.createDataFrame([(1, 0, "user", "x")], "conv_id long, turn long, role string, text string")
    plan = chat.digests(chat.format_conversations(df))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
