"""Chat formatting with Spark expressions only.

A conversation's turns are collected as structs, sorted, cut into runs of one role, and joined to
one string by array functions.  A run is one block of the template; its turns stay apart
by ``[NEXT]``, so reading back returns the turns as they were.  ``segments`` are the pieces
of the string with the loss mask; joined they are ``formatted``.

A control string inside a text (or a role's name) gets a backslash behind its first character,
however many stand there already; reading takes one away.  Other text stays as it is.

Edge cases: null texts and roles count as empty; turns of one number are ordered by role and
text, null turns first; repeated rows are turns of their own; a null conversation id is a
conversation; an empty table gives no rows; extra columns are not read, whatever their names.  A conversation is one row of the result, so it
must fit a row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from passagerank.llm.shared import text_of

#: Fixed values of the template: what opens and closes a role's block.
BLOCKS = {"system": ("[SYS] ", " [/SYS]"), "user": ("[INST] ", " [/INST]"), "assistant": ("[ANS] ", " </s>")}
OTHER = ("[ROLE] ", "[SAY] ", " [/ROLE]")
BEGIN, NEXT = "<s>", "[NEXT]"
NAMES = "s|INST|SYS|ANS|NEXT|ROLE|SAY"
LEARNED = "assistant"
#: Turns that are collected together before a conversation is.
TURNS = 1024


def escape(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])(\\*)(/?(?:{NAMES})[>\]])", r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])\\(\\*)(/?(?:{NAMES})[>\]])", "$1$2$3")


def turns_of(conversations: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """``conv_id, turns``: the sorted turns of every conversation, gathered by slices of it first."""
    number = F.col(turn).cast("long")
    rows = conversations.select(
        F.col(conv_id).alias("conv_id"),
        F.coalesce(F.floor(number / TURNS), F.lit(-(1 << 62))).alias("slice"),
        F.struct(number.alias("turn"), text_of(role).alias("role"), text_of(text).alias("text")).alias("t"),
    )
    slices = rows.groupBy("conv_id", "slice").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    whole = slices.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("slice", "turns"))).alias("slices"))
    return whole.select("conv_id", F.flatten(F.transform("slices", lambda s: s["turns"])).alias("turns"))


def _runs(turns: Column, starts: Column) -> Column:
    """Adjacent turns of one role as one run: its role and its texts."""

    def run(start, i):
        end = F.coalesce(F.get(starts, i + 1), F.size(turns))
        texts = F.transform(F.slice(turns, start + 1, end - start), lambda t: t["text"])
        return F.struct(F.get(turns, start)["role"].alias("role"), texts.alias("texts"))

    return F.transform(starts, run)


def _segments(run: Column) -> Column:
    def piece(text, loss):
        return F.struct(text.alias("text"), loss.alias("loss"))

    role, off = run["role"], F.lit(False)
    opened = F.concat(F.lit(OTHER[0]), escape(role), F.lit(OTHER[1]))
    closed = F.lit(OTHER[2])
    for name, (start, end) in BLOCKS.items():
        opened = F.when(role == name, F.lit(start)).otherwise(opened)
        closed = F.when(role == name, F.lit(end)).otherwise(closed)
    texts = F.transform(
        run["texts"],
        lambda t, i: F.when(i == 0, F.array(piece(escape(t), role == LEARNED))).otherwise(
            F.array(piece(F.lit(NEXT), off), piece(escape(t), role == LEARNED))
        ),
    )
    return F.concat(F.array(piece(opened, off)), F.flatten(texts), F.array(piece(closed, off)))


def format_conversations(
    conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """``conv_id, formatted, segments``; a segment is ``text, loss``."""
    starts = F.filter(
        F.sequence(F.lit(0), F.size("turns") - 1),
        lambda i: (i == 0) | (F.get("turns", i)["role"] != F.get("turns", i - 1)["role"]),
    )
    begin = F.array(F.struct(F.lit(BEGIN).alias("text"), F.lit(False).alias("loss")))
    return (
        turns_of(conversations, conv_id, turn, role, text)
        .withColumn("starts", starts)
        .withColumn("runs", _runs(F.col("turns"), F.col("starts")))
        .withColumn("segments", F.concat(begin, F.flatten(F.transform("runs", _segments))))
        .select("conv_id", F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"), "segments")
    )


def read_turns(formatted: Column) -> Column:
    """The turns ``role, text`` that a formatted conversation holds."""

    def turns(role, body):
        return F.transform(
            F.split(body, r"\[NEXT\]"), lambda t: F.struct(role.alias("role"), unescape(t).alias("text"))
        )

    def inside(block, start, end):
        return F.substring(block, F.lit(len(start) + 1), F.length(block) - len(start) - len(end))

    def read(block):
        named = inside(block, OTHER[0], OTHER[2])
        name = F.substring_index(named, OTHER[1], 1)
        said = F.substring(named, F.length(name) + len(OTHER[1]) + 1, F.length(named))
        out = turns(unescape(name), said)
        for role, (start, end) in BLOCKS.items():
            out = F.when(block.startswith(start), turns(F.lit(role), inside(block, start, end))).otherwise(out)
        return out

    blocks = F.split(F.substring(formatted, F.lit(len(BEGIN) + 1), F.length(formatted)), r"(?=\[(?:INST|SYS|ANS|ROLE)\] )")
    return F.flatten(F.transform(F.filter(blocks, lambda b: b != ""), read))


def learned_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")
