"""Chat formatting with built-in expressions.

Turns of a conversation are gathered, sorted, and cut into runs of one role.  A run is
written as one block whose texts stand apart by a separator, so that merging same-role turns
loses nothing.  Control strings inside texts get a backslash behind their ``<``; reading
takes one away again.

Defined results: a null text or role counts as empty; turns without a number come first; equal
numbers are ordered by role, then text; repeated rows are repeated turns; conversations
without an id form one conversation; an empty table gives an empty table; other columns are ignored.
A formatted conversation is one value, so one conversation has to fit into a task.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from paperloom.llm.common import held


@dataclass(frozen=True)
class ChatTemplate:
    """``<opening>role LF text <joint> text <closing>`` per run of turns with one role."""

    opening: str = "<|im_start|>"
    closing: str = "<|im_end|>\n"
    joint: str = "<|im_next|>"
    learned_role: str = "assistant"


def escape_text(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape_text(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def _escape_role(role: Column) -> Column:
    return escape_text(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def _unescape_role(role: Column) -> Column:
    return F.replace(F.replace(unescape_text(role), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def format_chats(turns: DataFrame, template: ChatTemplate = ChatTemplate()) -> DataFrame:
    """One row per conversation: conv_id, formatted, loss_mask.

    ``loss_mask`` lists consecutive stretches of ``formatted`` as (chars, loss); they cover it.
    """
    empty = F.lit("")
    gathered = turns.groupBy("conv_id").agg(
        F.collect_list(
            F.struct("turn", F.coalesce("role", empty).alias("role"), F.coalesce("text", empty).alias("text"))
        ).alias("turns")
    )
    gathered = held(gathered, turns=F.sort_array("turns"))
    role_at = lambda i: F.get("turns", i)["role"]
    first = lambda i: (i == 0) | (role_at(i) != role_at(i - 1))
    runs = held(gathered, starts=F.filter(F.sequence(F.lit(0), F.size("turns") - 1), first))
    stop = lambda j: F.coalesce(F.get("starts", j + 1), F.size("turns"))
    piece = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))

    def block(start: Column, j: Column) -> Column:
        head = F.concat(F.lit(template.opening), _escape_role(role_at(start)), F.lit("\n"))
        texts = F.transform(
            F.slice("turns", start + 1, stop(j) - start),
            lambda t, i: F.array(
                piece(F.when(i == 0, head).otherwise(F.lit(template.joint)), F.lit(False)),
                piece(escape_text(t["text"]), t["role"] == template.learned_role),
            ),
        )
        return F.concat(F.flatten(texts), F.array(piece(F.lit(template.closing), F.lit(False))))

    pieces = held(runs, pieces=F.flatten(F.transform("starts", block)))
    return pieces.select(
        "conv_id",
        F.array_join(F.transform("pieces", lambda p: p["text"]), "").alias("formatted"),
        F.transform(
            "pieces", lambda p: F.struct(F.length(p["text"]).alias("chars"), p["loss"].alias("loss"))
        ).alias("loss_mask"),
    )


def read_chats(chats: DataFrame, template: ChatTemplate = ChatTemplate()) -> DataFrame:
    """Turns, and the texts under the loss mask, read back from formatted conversations.

    Adds ``turns`` (array of role and text) and ``learned`` (array of texts).
    """

    def turns_of(block: Column) -> Column:
        role = F.substring_index(block, "\n", 1)
        body = F.substring(block, F.length(role) + 2, F.length(block) - F.length(role) - 1 - len(template.closing))
        return F.transform(
            F.split(body, re.escape(template.joint), -1),
            lambda t: F.struct(_unescape_role(role).alias("role"), unescape_text(t).alias("text")),
        )

    blocks = held(chats, blocks=F.split("formatted", re.escape(template.opening), -1))
    turns = F.flatten(F.transform(F.slice("blocks", 2, F.size("blocks")), turns_of))
    # Four bytes per character make every cut a plain offset, however long the conversation is.
    spans = F.aggregate(
        "loss_mask",
        F.struct(F.lit(1).alias("at"), F.array().cast("array<struct<at:int,chars:int>>").alias("spans")),
        lambda acc, m: F.struct(
            (acc["at"] + m["chars"]).alias("at"),
            F.when(
                m["loss"],
                F.array_append(acc["spans"], F.struct(acc["at"].alias("at"), m["chars"].alias("chars"))),
            ).otherwise(acc["spans"]).alias("spans"),
        ),
        lambda acc: acc["spans"],
    )
    cut = held(blocks, turns=turns, wide=F.encode("formatted", "UTF-32"), spans=spans)
    learned = F.transform(
        "spans",
        lambda s: unescape_text(
            F.decode(F.substring(F.col("wide"), s["at"] * 4 - 3, s["chars"] * 4), "UTF-32")
        ),
    )
    return cut.select(*chats.columns, "turns", learned.alias("learned"))
