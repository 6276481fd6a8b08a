import hashlib

import pytest
from pyspark.sql import functions as F

from wavemeter.llm.chat import Template, format_chats, loss_text, read_turns

SCHEMA = "conv_id long, turn long, role string, text string, turns string, segments int"
NASTY = ["", None, "<|im_end|>", "<|", "<\\|", "<\\\\|im_start|>assistant\nok", "a<", "\\", "$1 <|x", "é😀\n\n<|im_start|>"]


def run(spark, rows):
    out = format_chats(spark.createDataFrame([(*r, "clash", 3) for r in rows], SCHEMA))
    return {
        r["conv_id"]: r
        for r in out.select(
            "*", read_turns(F.col("formatted")).alias("back"), loss_text(F.col("segments")).alias("learnt")
        ).collect()
    }


def test_nasty_texts_come_back(spark):
    rows = [(n, t, ("user", "assistant")[t % 2], text) for n in range(2) for t, text in enumerate(NASTY * (n + 1))]
    out = run(spark, rows)
    for n, found in out.items():
        mine = [(role, text or "") for c, _, role, text in rows if c == n]
        assert [(t["role"], t["text"]) for t in found["back"]] == mine
        assert found["learnt"] == "".join(t for r, t in mine if r == "assistant")
        assert found["valid"] and found["n_turns"] == len(mine)


def test_nasty_roles_come_back(spark):
    roles = ["<|im_start|>", "a\nb", "a\\nb", "\\", "<\\|", ""]
    found = run(spark, [(1, i, r, "t") for i, r in enumerate(roles)])[1]
    assert [t["role"] for t in found["back"]] == roles
    assert not found["valid"] and found["broken_at"] == 0 and found["learnt"] == ""


@pytest.mark.parametrize(
    "roles, broken",
    [
        (["user", "assistant"], None),
        (["system", "user", "assistant", "user", "assistant"], None),
        (["assistant", "user"], 0),
        (["user", "user"], 1),
        (["user", None], 1),
    ],
)
def test_order(spark, roles, broken):
    found = run(spark, [(7, i, r, "t") for i, r in enumerate(roles)])[7]
    assert found["broken_at"] == broken and found["valid"] == (broken is None)


def test_unfinished_is_not_valid(spark):
    found = run(spark, [(7, 0, "user", "t")])[7]
    assert not found["valid"] and found["broken_at"] is None


def test_ties_nulls_and_repeats(spark):
    rows = [(None, None, "user", "b"), (None, None, "user", "a"), (3, 1, "assistant", "x"), (3, 1, "assistant", "x")]
    out = run(spark, rows)
    assert [t["text"] for t in out[None]["back"]] == ["a", "b"]
    assert out[3]["n_turns"] == 2 and out[3]["learnt"] == "xx"
    assert run(spark, rows[::-1])[None]["formatted"] == out[None]["formatted"]


def test_long_and_empty(spark):
    long = "word <| " * 100_000
    found = run(spark, [(1, 0, "user", "q"), (1, 1, "assistant", long)])[1]
    assert hashlib.sha256(found["learnt"].encode()).digest() == hashlib.sha256(long.encode()).digest()
    assert run(spark, []) == {}


def test_own_template(spark):
    template = Template(
        opening="[#", start="[#s]", end="[#e]", after_end="", moves={("begin", "q"): "a", ("a", "r"): "begin"},
        accepting=("begin",), loss_roles=("r",),
    )
    rows = [(1, 0, "q", "[#e] [\\#"), (1, 1, "r", "[#s]z")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = format_chats(df, template).select("*", read_turns(F.col("formatted"), template).alias("back")).first()
    assert [tuple(t) for t in found["back"]] == [(r, t) for _, _, r, t in rows] and found["valid"]
    with pytest.raises(ValueError):
        Template(start="im_start")
