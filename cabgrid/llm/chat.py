r"""Chat formatting with Spark expressions only.

Format: a block per run of turns of one role, ``### role:`` and a line break,
the texts with ``<next>`` between them, then ``</turn>`` and a line break.
Inside roles and texts ``\``, ``<`` and ``#`` (in roles also ``:``) are written
``\b``, ``\l``, ``\h`` and ``\c``, so the marks never occur there and reading
back is exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The template.
OPEN, HEAD_END, NEXT, CLOSE = "### ", ":\n", "<next>", "</turn>\n"


def _replaced(col: Column, old: str, new: str) -> Column:
    return F.replace(col, F.lit(old), F.lit(new))


def escaped(col: Column) -> Column:
    return _replaced(_replaced(_replaced(col, "\\", "\\b"), "<", "\\l"), "#", "\\h")


def unescaped(col: Column) -> Column:
    return _replaced(_replaced(_replaced(_replaced(col, "\\l", "<"), "\\h", "#"), "\\c", ":"), "\\b", "\\")


def format_chats(
    turns: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    loss_role: str = "assistant",
) -> DataFrame:
    """``conv_id``, ``formatted`` and ``loss_spans`` (start, length in code points), one row per conversation.

    Turns are sorted by turn number (null first), ties by role and text; a
    conversation's turns make one output row by definition. Adjacent turns of
    one role share a block but keep their texts apart. Null roles and texts
    count as empty; rows with a null id form one conversation; repeated rows
    are turns of their own. The loss mask covers each text of ``loss_role``,
    without marks. An empty table gives an empty result.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    turn = F.struct(F.col(turn_col).alias("turn"), role.alias("role"), text.alias("text"))
    chats = turns.select(F.col(conv_col).alias(conv_col), turn.alias("t"))
    chats = chats.groupBy(conv_col).agg(F.sort_array(F.collect_list("t")).alias("turns"))
    # A piece per turn: what stands before its text, the text, what stands after it.
    pieces = F.transform(
        F.sequence(F.lit(0), F.size("turns") - 1),
        lambda i: F.struct(
            (F.get("turns", i)["role"] == loss_role).alias("loss"),
            F.when((i > 0) & (F.get("turns", i - 1)["role"] == F.get("turns", i)["role"]), F.lit(NEXT))
            .otherwise(F.concat(F.lit(OPEN), _replaced(escaped(F.get("turns", i)["role"]), ":", "\\c"), F.lit(HEAD_END)))
            .alias("head"),
            escaped(F.get("turns", i)["text"]).alias("body"),
            F.when(
                (i + 1 < F.size("turns")) & (F.get("turns", i + 1)["role"] == F.get("turns", i)["role"]), F.lit("")
            )
            .otherwise(F.lit(CLOSE))
            .alias("tail"),
        ),
    )
    chats = chats.select(conv_col, pieces.alias("pieces"))
    # Spans by a running length over the pieces.
    spans = F.aggregate(
        "pieces",
        F.struct(F.lit(1).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans")),
        lambda acc, p: F.struct(
            (acc["at"] + F.length(p["head"]) + F.length(p["body"]) + F.length(p["tail"])).alias("at"),
            F.when(
                p["loss"],
                F.concat(
                    acc["spans"],
                    F.array(F.struct((acc["at"] + F.length(p["head"])).alias("start"), F.length(p["body"]).alias("length"))),
                ),
            )
            .otherwise(acc["spans"])
            .alias("spans"),
        ),
        lambda acc: acc["spans"],
    )
    text = F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["body"], p["tail"])), "")
    return chats.select(conv_col, text.alias("formatted"), spans.alias("loss_spans"))


def read_turns(formatted: Column) -> Column:
    """The turns (``role``, ``text``) of a formatted conversation, in order."""
    blocks = F.filter(F.split(formatted, CLOSE), lambda b: b != "")
    cut = lambda b: F.instr(b, HEAD_END)
    return F.flatten(
        F.transform(
            blocks,
            lambda b: F.transform(
                F.split(F.substring(b, cut(b) + F.lit(len(HEAD_END)), F.length(b)), NEXT),
                lambda t: F.struct(
                    unescaped(F.substring(b, F.lit(len(OPEN) + 1), cut(b) - F.lit(len(OPEN) + 1))).alias("role"),
                    unescaped(t).alias("text"),
                ),
            ),
        )
    )


def read_loss(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(spans, lambda s: unescaped(F.substring(formatted, s["start"], s["length"]))), "")
