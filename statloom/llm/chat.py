"""Chat formatting by prefix-target expansion, in DataFrame functions only.

A conversation of n turns is written as one text in which control strings mark the turns. Every
assistant turn gives an example: the conversation's text up to the end of that reply, of which
the reply alone is trainable. Turns after the last reply (or a conversation without replies)
give one more example that trains nothing, so that the output holds every turn.

Control strings inside a role or a text are broken by a backslash after their first character,
and a run of backslashes there grows by one, so unescaping gives back the very text.

Defined results: rows are ordered by (turn, role, text), nulls first; a null role or text is
empty; a null conv_id is a conversation of its own; repeated rows are repeated turns; columns other
than conv_id, turn, role and text are not read; an empty table gives no example.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
TARGET_ROLE = "assistant"

#: The control strings that a text must not contain unbroken, without their opener.
_TAILS = (r"(?:/?s>|/?INST\]|/?SYS>>|\|(?:im_start|im_sep|im_end|endoftext)\|>)")
ESCAPE = rf"([<\[])(\\*)({_TAILS})"
UNESCAPE = rf"([<\[])\\(\\*)({_TAILS})"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPE, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, UNESCAPE, "$1$2$3")


def conversations(turns: DataFrame) -> DataFrame:
    """conv_id and its turns in order, as an array of (turn, role, text).

    A conversation is one row: its examples need its turns side by side.
    """
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"),
                    F.coalesce("text", F.lit("")).alias("text"))
    return (turns.select("conv_id", turn.alias("t"))
            .groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns")))


def examples(turns: DataFrame, target_role: str = TARGET_ROLE) -> DataFrame:
    """One row per example.

    conv_id, example (its number, from 0), text (context and reply), loss_start (code points before
    the reply's text) and loss_chars (0 where nothing is trained), n_turns (turns in the text),
    last (it holds the whole conversation).
    """
    head = lambda t: F.concat(F.lit(START), escape(t["role"]), F.lit(SEP))
    body = lambda t: escape(t["text"])
    whole = lambda t: F.concat(head(t), body(t), F.lit(END))
    # Where each turn ends in the conversation's text: a running sum of lengths.
    ends = F.aggregate(
        "parts", F.array(F.lit(0).cast("long")),
        lambda acc, p: F.concat(acc, F.array(F.element_at(acc, -1) + F.char_length(p).cast("long"))))
    spans = F.transform("turns", lambda t, i: F.struct(
        (i + 1).alias("n_turns"), (t["role"] == target_role).alias("trained"),
        F.char_length(head(t)).alias("head"), F.char_length(body(t)).alias("body"),
        F.element_at("ends", i + 1).alias("begin"), F.element_at("ends", i + 2).alias("end")))
    wanted = F.filter("spans", lambda s: s["trained"] | (s["n_turns"] == F.size("spans")))
    return (
        conversations(turns)
        .select("conv_id", "turns", F.transform("turns", whole).alias("parts"))
        .select("conv_id", "turns", F.concat_ws("", "parts").alias("full"), ends.alias("ends"))
        .select("conv_id", "full", spans.alias("spans"))
        .select("conv_id", "full", F.size("spans").alias("size"),
                F.posexplode(wanted).alias("example", "s"))
        .select(
            "conv_id", F.col("example").cast("long").alias("example"),
            F.substring(F.col("full"), F.lit(1), F.col("s.end").cast("int")).alias("text"),
            (F.col("s.begin") + F.col("s.head")).alias("loss_start"),
            F.when(F.col("s.trained"), F.col("s.body")).otherwise(0).cast("long")
            .alias("loss_chars"),
            F.col("s.n_turns").cast("long").alias("n_turns"),
            (F.col("s.n_turns") == F.col("size")).alias("last"),
        )
    )


def digest(out: DataFrame) -> DataFrame:
    """What the examples hold, read back from their texts, a row per conversation.

    Turns are split at the control strings of the longest example; the loss digest takes the
    trainable span of each example in order.
    """
    reply = F.substring(F.col("text"), (F.col("loss_start") + 1).cast("int"),
                        F.col("loss_chars").cast("int"))
    pieces = F.slice(F.split("whole", r"<\|im_start\|>"), 2, 1 << 30)
    said = lambda p: F.concat(
        unescape(F.substring_index(p, SEP, 1)), F.lit("\n"),
        unescape(F.regexp_replace(p, r"(?s)^.*?<\|im_sep\|>|<\|im_end\|>$", "")), F.lit("\n"))
    # The examples of a conversation are still together, so this groups without a shuffle.
    by_conversation = out.groupBy("conv_id").agg(
        F.max(F.when(F.col("last"), F.col("text"))).alias("whole"),
        F.sort_array(F.collect_list(F.struct("example", unescape(reply).alias("reply"))))
        .alias("replies"),
        F.sum(F.char_length("text").cast("long")).alias("formatted_chars"),
    )
    lost = F.concat_ws("", F.col("replies.reply"))
    return by_conversation.select(
        "conv_id", F.size(pieces).cast("long").alias("n_turns"),
        F.sha2(F.concat_ws("", F.transform(pieces, said)).cast("binary"), 256)
        .alias("turns_sha256"),
        F.char_length(lost).cast("long").alias("loss_chars"),
        F.sha2(lost.cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars",
    )
