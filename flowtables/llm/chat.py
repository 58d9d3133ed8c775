"""Chat formatting: every assistant turn becomes an example with all turns before it as context.

A conversation is one text of turns ``### role: text</turn>\\n``. The control strings ``###``, ``</turn>`` and ``:`` of
a role cannot come from inside: ``\\``, ``#``, ``<`` (and ``:`` in roles) are written as a backslash and a letter, which
is undone by plain replacement. Example k is the text up to the end of its assistant turn; only that reply is under the
loss mask. As all examples of a conversation are prefixes of one text, they are kept as borders (linear in the
conversation) and written out only by ``explode_examples``.

Null text, role or turn: text and role count as empty, null turns come first. Turns of equal number are ordered by role
and text; repeated rows stay repeated turns. Rows without conv_id form one conversation. An empty table gives no rows.
A conversation must fit a cell, as its one digest has to be taken over its whole text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPEN, CLOSE = "### ", "</turn>\n"
#: Control characters and how they are written.
ESCAPES = (("\\", "\\b"), ("#", "\\h"), ("<", "\\l"))
ROLE_ESCAPES = (*ESCAPES, (":", "\\c"))


def escape(text: Column, escapes=ESCAPES) -> Column:
    for plain, written in escapes:
        text = F.replace(text, F.lit(plain), F.lit(written))
    return text


def unescape(text: Column, escapes=ESCAPES) -> Column:
    for plain, written in reversed(escapes):
        text = F.replace(text, F.lit(written), F.lit(plain))
    return text


def format_conversations(turns: DataFrame, trained_role: str = "assistant") -> DataFrame:
    """``conv_id, formatted, examples``: examples are structs ``example, example_end, loss_begin, loss_end`` (code points)."""
    head = F.concat(F.lit(OPEN), escape(F.col("role"), ROLE_ESCAPES), F.lit(": "))
    body = escape(F.col("text"))
    in_order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    before = F.sum(F.length("written")).over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    placed = (
        turns.select("conv_id", "turn", *(F.coalesce(c, F.lit("")).alias(c) for c in ("role", "text")))
        .withColumn("head", F.length(head).cast("long"))
        .withColumn("body", F.length(body).cast("long"))
        .withColumn("written", F.concat(head, body, F.lit(CLOSE)))
        .withColumn("begin", F.coalesce(before, F.lit(0)))
    )
    turn_list = placed.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("begin", "written", "head", "body", "role"))).alias("ts")
    )
    trained = F.filter("ts", lambda t: t["role"] == trained_role)
    return turn_list.select(
        "conv_id",
        F.array_join(F.transform("ts", lambda t: t["written"]), "").alias("formatted"),
        F.transform(
            trained,
            lambda t, i: F.struct(
                i.cast("long").alias("example"),
                (t["begin"] + F.length(t["written"])).alias("example_end"),
                (t["begin"] + t["head"]).alias("loss_begin"),
                (t["begin"] + t["head"] + t["body"]).alias("loss_end"),
            ),
        ).alias("examples"),
    )


def explode_examples(formatted: DataFrame) -> DataFrame:
    """A row per assistant turn: ``conv_id, formatted, example, text, loss_begin, loss_end``; text is context and reply.

    A conversation without such a turn keeps one row whose example is null.
    """
    return formatted.select("conv_id", "formatted", F.explode_outer("examples").alias("e")).select(
        "conv_id",
        "formatted",
        "e.example",
        F.substring("formatted", F.lit(1), F.col("e.example_end").cast("int")).alias("text"),
        "e.loss_begin",
        "e.loss_end",
    )


def trained_text() -> Column:
    """The text under an example's loss mask, as it was before escaping."""
    begin, end = F.col("loss_begin"), F.col("loss_end")
    return unescape(F.substring("text", (begin + 1).cast("int"), (end - begin).cast("int")))


def parse_turns(formatted: Column) -> Column:
    """The turns of a formatted text as an array of structs ``role, text``."""
    written = F.filter(F.split(formatted, CLOSE), lambda x: x != "")

    def turn(x: Column) -> Column:
        colon = F.instr(x, ": ")
        role = F.substring(x, F.lit(len(OPEN) + 1), colon - len(OPEN) - 1)
        return F.struct(
            unescape(role, ROLE_ESCAPES).alias("role"),
            unescape(F.substring(x, colon + 2, F.length(x))).alias("text"),
        )

    return F.transform(written, turn)


def conversation_digests(turns: DataFrame) -> DataFrame:
    """What the examples hold, read back from them, one row per conversation."""
    losses = (
        explode_examples(format_conversations(turns))
        .withColumn("loss", trained_text())
        .groupBy("conv_id")
        .agg(
            F.first("formatted").alias("formatted"),
            F.sort_array(F.collect_list(F.when(F.col("example").isNotNull(), F.struct("example", "loss")))).alias("losses"),
        )
    )
    parts = F.transform(
        parse_turns(F.col("formatted")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))
    )
    loss = F.array_join(F.transform("losses", lambda e: e["loss"]), "")
    return losses.select(
        "conv_id",
        F.size(parts).cast("long").alias("n_turns"),
        F.sha2(F.array_join(parts, ""), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        F.size("losses").cast("long").alias("n_examples"),
    )
