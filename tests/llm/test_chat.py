"""Round trips of the chat grammar."""

import random
import re

from pyspark.sql import functions as F

from freshet.llm import chat

PIECES = ["<s>", "</s>", "[INST]", "[/INST]", "\\", "<", "[", "/", "s>", "INST]", "<\\s>", "[\\\\/INST]", "ok", " ", "\n", "é😀", "$1", "</"]


def conversations():
    draw = random.Random(4)
    rows = []
    for conv in range(150):
        for turn in range(draw.randint(1, 6)):
            text = "".join(draw.choice(PIECES) for _ in range(draw.randint(0, 9)))
            role = draw.choice(["user", "assistant", "system", "assistant", "".join(draw.choice(PIECES) for _ in range(3))])
            rows.append((conv, turn, role, text, "x"))
    rows += [(900, 0, "user", None, None), (900, 1, None, "a", None), (901, 0, "assistant", "w " * 60_000 + "</s>", "y")]
    return rows


SCHEMA = "conv_id long, turn long, role string, text string, formatted string"


def test_every_turn_is_read_back(spark):
    rows = conversations()
    got = chat.formatted(spark.createDataFrame(rows, SCHEMA).repartition(5))
    got = got.select("conv_id", "formatted", "loss", chat.parse(F.col("formatted")).alias("turns")).collect()
    want = {}
    for conv, _, role, text, _ in sorted(rows, key=lambda r: (r[0], r[1])):
        want.setdefault(conv, []).append((role or "", text or ""))
    assert {r["conv_id"]: [tuple(t) for t in r["turns"]] for r in got} == want
    for r in got:
        bodies = [t for role, t in want[r["conv_id"]] if role == "assistant"]
        cut = [r["formatted"][s["start"] : s["end"]] for s in r["loss"]]
        assert len(cut) == len(bodies)
        assert [re.sub(r"(?<=<)\\(?=\\*/?s>)|(?<=\[)\\(?=\\*/?INST\])", "", raw) for raw in cut] == bodies


def test_the_mask_is_what_the_loss_is_read_through(spark):
    rows = conversations()
    told = chat.formatted(spark.createDataFrame(rows, SCHEMA))
    want = {}
    for conv, _, role, text, _ in sorted(rows, key=lambda r: (r[0], r[1])):
        want.setdefault(conv, []).extend([text or ""] if role == "assistant" else [])

    def read(loss):
        return {r["conv_id"]: r["t"] for r in told.select("conv_id", chat.masked(F.col("formatted"), loss).alias("t")).collect()}

    assert read(F.col("loss")) == want
    moved = F.transform("loss", lambda s: F.struct((s["start"] + 1).alias("start"), (s["end"] + 1).alias("end")))
    missing = F.slice("loss", F.lit(2), F.greatest(F.size("loss"), F.lit(1)))
    for wrong in (moved, missing):
        got = read(wrong)
        # A text of one character over and over may look the same when the mask is off by one.
        assert all(got[c] != want[c] for c in want if any(len(set(t)) > 2 for t in want[c][:1]))
        assert sum(got[c] != want[c] for c in want) > 90


def test_texts_without_control_strings_are_left_alone(spark):
    one = spark.createDataFrame([("user", "a < b [x] \\ <div> \\n"), ("assistant", "<\\s>")], "role string, text string")
    got = [r[0] for r in one.select(chat.verified(F.col("role"), F.col("text"))).collect()]
    assert got[0] == "<s>[INST]user[/INST]a < b [x] \\ <div> \\n</s>"
    assert got[1] == "<s>[INST]assistant[/INST]<\\\\s></s>"


def test_ties_missing_turns_and_ids(spark):
    rows = [(1, 0, "user", "b"), (1, 0, "user", "a"), (1, None, "system", "first"), (None, 0, "user", "x"), (None, 1, "user", "x"), (1, 0, "user", "a")]
    docs = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r["conv_id"]: [t["text"] for t in r["t"]] for r in chat.formatted(docs).select("conv_id", chat.parse(F.col("formatted")).alias("t")).collect()}
    assert got == {1: ["first", "a", "a", "b"], None: ["x", "x"]}


def test_what_breaks_the_grammar_has_null_parts(spark):
    bad = ["<s>[INST]user[/INST]a", "user[/INST]a</s>", "<s>[INST]user a</s>", "<s>[INST]u[/INST]a[/INST]b</s>"]
    got = spark.createDataFrame([(b,) for b in bad], "f string").select(chat.parse(F.col("f"))).collect()
    assert got[0][0] is None
    assert all(tuple(r[0][0]) == (None, None) for r in got[1:])


def test_empty_table_and_no_python(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert chat.formatted(none).count() == 0
    text = chat.formatted(none)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Arrow" not in text
