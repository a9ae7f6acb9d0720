"""Chat formatting with Spark expressions only.

The turns of a conversation are collected as structs and sorted by (turn,
role, text); an array aggregation over neighbours merges adjacent turns of the
same role, and the pieces are concatenated once (linear in the text). Template
of a message::

    <turn>### role: text<part>text</turn>\\n

``<part>`` separates merged turns, so that they can be told apart again.
Inside texts and roles the template's control characters are escaped:
``\\`` as ``\\b``, ``<`` as ``\\l``, ``#`` as ``\\h`` and, in roles, ``:`` as
``\\c``. No escape holds a character that is itself escaped later and every
backslash is followed by a letter of its own, so plain replacements undo it.

``read_back`` parses the formatted string alone. The loss mask covers the texts
of assistant messages, part marks excluded.

A conversation is one output row, so its length bounds a row; rows meet in
one task only for their own conversation. Defined results: NULL text and NULL
role read as empty; a NULL turn sorts first; equal turn numbers sort by role,
then text; repeated rows are repeated turns; NULL conversation ids form one
conversation; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import col

START, AFTER_ROLE, PART, END = "<turn>### ", ": ", "<part>", "</turn>\n"
ASSISTANT = "assistant"
ESCAPES = (("\\", "\\b"), ("<", "\\l"), ("#", "\\h"), (":", "\\c"))


def escaped(text: Column, role: bool = False) -> Column:
    for char, code in ESCAPES if role else ESCAPES[:3]:
        text = F.replace(text, F.lit(char), F.lit(code))
    return text


def unescaped(text: Column, role: bool = False) -> Column:
    for char, code in reversed(ESCAPES if role else ESCAPES[:3]):
        text = F.replace(text, F.lit(code), F.lit(char))
    return text


def format_chats(
    rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """One row per conversation: ``conv_id, n_messages, formatted``."""
    turns = (
        rows.select(
            col(conv).alias("conv_id"),
            F.struct(
                col(turn).alias("turn"),
                F.coalesce(col(role).cast("string"), F.lit("")).alias("role"),
                F.coalesce(col(text).cast("string"), F.lit("")).alias("text"),
            ).alias("t"),
        )
        .groupBy("conv_id")
        .agg(F.sort_array(F.collect_list("t")).alias("turns"))
    )

    def piece(t: Column, i: Column) -> Column:
        head = F.concat(F.lit(START), escaped(t["role"], role=True), F.lit(AFTER_ROLE))
        same = F.get("turns", i - 1)["role"] == t["role"]
        lead = F.when(i == 0, head).when(same, F.lit(PART)).otherwise(F.concat(F.lit(END), head))
        return F.concat(lead, escaped(t["text"]))

    runs = F.aggregate(
        "turns",
        F.struct(F.lit(None).cast("string").alias("role"), F.lit(0).cast("long").alias("n")),
        lambda done, t: F.struct(
            t["role"].alias("role"),
            (done["n"] + F.when(done["role"].eqNullSafe(t["role"]), 0).otherwise(1)).cast("long").alias("n"),
        ),
        lambda done: done["n"],
    )
    return turns.select(
        "conv_id",
        runs.alias("n_messages"),
        F.concat(F.array_join(F.transform("turns", piece), ""), F.lit(END)).alias("formatted"),
    )


def read_back(formatted: Column) -> Column:
    """The turns in a formatted string: an array of ``(role, text)`` structs, in order.

    No ``<`` is left inside texts, so every mark that is found is the template's.
    """
    messages = F.filter(F.split(formatted, END), lambda m: m != "")
    body = F.transform(messages, lambda m: F.substr(m, F.lit(len(START) + 1)))
    return F.flatten(
        F.transform(
            body,
            lambda b: F.transform(
                F.split(F.substr(b, F.instr(b, AFTER_ROLE) + len(AFTER_ROLE)), PART),
                lambda p: F.struct(
                    unescaped(F.substring_index(b, AFTER_ROLE, 1), role=True).alias("role"),
                    unescaped(p).alias("text"),
                ),
            ),
        )
    )


def digests(chats: DataFrame) -> DataFrame:
    """What can be read back from ``formatted``: turns, their digest, and the text under the loss mask."""
    read = chats.withColumn("back", read_back(F.col("formatted")))
    loss = F.array_join(F.transform(F.filter("back", lambda t: t["role"] == ASSISTANT), lambda t: t["text"]), "")
    said = F.array_join(F.transform("back", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("back").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.char_length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
        "n_messages",
    )
