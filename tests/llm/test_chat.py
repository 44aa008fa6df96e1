"""Prefix-target examples: against plain Python, and read back from their texts."""

from __future__ import annotations

import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from statloom.llm import chat

TURNS = "conv_id long, turn long, role string, text string"
NASTY = ["", "</s>", "<\\/s>", "<\\\\/s>[INST]", "a <|im_end|> b", "<|im_start|>user<|im_sep|>x",
         "[INST] ok [/INST]", "<<SYS>>", "line\nline", "\\", "<", "é<s>é", "<\\", "$1 \\2"]


def expected(rows):
    out = {}
    by_conversation = {}
    for conv, turn, role, text in rows:
        by_conversation.setdefault(conv, []).append(
            ((turn is not None, turn or 0), role or "", text or ""))
    for conv, turns in by_conversation.items():
        turns.sort()
        said = "".join(f"{r}\n{t}\n" for _, r, t in turns)
        lost = "".join(t for _, r, t in turns if r == "assistant")
        out[conv] = (len(turns), hashlib.sha256(said.encode()).hexdigest(), len(lost),
                     hashlib.sha256(lost.encode()).hexdigest())
    return out


def check(spark, rows):
    df = spark.createDataFrame(rows, TURNS).selectExpr("*", "'x' AS example", "'y' AS ends")
    found = {r.conv_id: r for r in chat.digest(chat.examples(df)).collect()}
    want = expected(rows)
    assert found.keys() == want.keys()
    for conv, values in want.items():
        r = found[conv]
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == values
        assert r.formatted_chars > 0


def test_control_strings_come_back(spark):
    rows = [(i, j, ["user", "assistant"][j % 2], t + u)
            for i, t in enumerate(NASTY) for j, u in enumerate(NASTY)]
    check(spark, rows)


def test_nulls_ties_and_repeats(spark):
    check(spark, [(None, 1, "assistant", "a"), (1, None, None, None), (1, 0, "assistant", None),
                  (1, 0, "assistant", "z"), (1, 0, "assistant", "z"), (2, 0, "user", "only user"),
                  (3, 0, "<|im_sep|>", "odd role"), (4, 0, "assistant", "x" * 50_000)])


def test_escape_leaves_no_control_string(spark):
    @settings(max_examples=15, deadline=None)
    @given(st.lists(st.lists(st.sampled_from([*NASTY, "/s>", "[", "|im_end|>"]), max_size=6)
                    .map("".join), min_size=1, max_size=20))
    def run(texts):
        df = spark.createDataFrame([(t,) for t in texts], "t string").select(
            "t", chat.escape(chat.F.col("t")).alias("e"))
        for r in df.select("t", "e", chat.unescape(chat.F.col("e")).alias("u")).collect():
            assert r.u == r.t
            assert not any(s in r.e for s in ("</s>", "<s>", "[INST]", "[/INST]", chat.START,
                                              chat.SEP, chat.END))
    run()


def test_every_reply_has_its_example(spark):
    rows = [(1, 0, "system", "s"), (1, 1, "user", "u"), (1, 2, "assistant", "first"),
            (1, 3, "user", "v"), (1, 4, "assistant", "second"), (1, 5, "user", "w")]
    out = chat.examples(spark.createDataFrame(rows, TURNS)).orderBy("example").collect()
    masked = [r.text[r.loss_start:r.loss_start + r.loss_chars] for r in out]
    assert masked == ["first", "second", ""]
    assert [r.n_turns for r in out] == [3, 5, 6]
    assert all(b.text.startswith(a.text) for a, b in zip(out, out[1:]))


def test_empty(spark):
    assert chat.digest(chat.examples(spark.createDataFrame([], TURNS))).count() == 0


def test_no_python_and_one_shuffle(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    out = chat.digest(chat.examples(df))
    plan = out._sc._jvm.PythonSQLUtils.explainString(out._jdf.queryExecution(), "formatted")
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
    assert plan.count("Exchange (") <= 2  # in the tree, and in its details
