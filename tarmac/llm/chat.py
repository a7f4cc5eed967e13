"""Chat formatting with expressions only.

Template: each run of turns of one role is a block, `[INST]role[/INST]text<s>text</s>`; `<s>` stands
between the merged texts. A backslash goes into every control string that occurs in a role or a text, so
the four control strings occur nowhere but as marks, and a formatted conversation reads back to its turns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import indexes

ROLE, BODY, MORE, END = "[INST]", "[/INST]", "<s>", "</s>"
CONTROLS = (ROLE, BODY, MORE, END)


def escaped(text: Column) -> Column:
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for c in CONTROLS:
        text = F.replace(text, F.lit(c), F.lit(f"{c[0]}\\{c[1:]}"))
    return text


def unescaped(text: Column) -> Column:
    for c in CONTROLS:
        text = F.replace(text, F.lit(f"{c[0]}\\{c[1:]}"), F.lit(c))
    return F.replace(text, F.lit("\\\\"), F.lit("\\"))


def _quoted(control: str) -> str:
    return rf"\Q{control}\E"


def _segment(text: Column, loss: Column) -> Column:
    return F.struct(text.alias("text"), loss.alias("loss"))


def format_conversations(
    turns: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    loss_role: str = "assistant",
) -> DataFrame:
    """One row per conversation: its id, `n_blocks`, `segments`, `formatted`.

    `segments` is the output as an array of (text, loss): loss marks what is learned, which is each
    text of `loss_role` and none of the marks. `formatted` is the segments put together. Turns
    go by turn number (null first), then role, then text, so ties and repeated rows have one
    result; null role or text is empty; a null conversation id is a conversation of its own.
    Turns are escaped before they are collected; nothing is done per conversation but sorting and joining.
    An empty table gives an empty result. Other columns are ignored.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    role = F.coalesce(F.col(role_col).cast("string"), F.lit(""))
    rows = turns.select(
        F.col(conv_col).alias("conv"),
        F.struct(
            F.col(turn_col).alias("turn"),
            role.alias("plain"),
            text.alias("order"),
            escaped(role).alias("role"),
            escaped(text).alias("text"),
        ).alias("t"),
    )
    sorted_turns = F.sort_array(F.collect_list("t"))
    kept = F.transform(sorted_turns, lambda x: F.struct(x["plain"], x["role"], x["text"]))
    convs = rows.groupBy("conv").agg(kept.alias("turns"))
    t = F.col("turns")
    first = F.filter(
        indexes(F.size(t)), lambda i: (i == 0) | (F.get(t, i)["plain"] != F.get(t, i - 1)["plain"])
    )
    convs = convs.withColumn("first", first)
    start = F.col("first")

    def block(i: Column, k: Column) -> Column:
        end = F.coalesce(F.get(start, k + 1), F.size(t))
        own = F.slice(t, i + 1, end - i)
        learned = F.get(t, i)["plain"] == loss_role
        no = F.lit(False)
        head = F.array(_segment(F.concat(F.lit(ROLE), F.get(t, i)["role"], F.lit(BODY)), no))
        texts = F.flatten(
            F.transform(own, lambda x: F.array(_segment(x["text"], learned), _segment(F.lit(MORE), no)))
        )
        body = F.slice(texts, F.lit(1), F.size(texts) - 1)
        return F.concat(head, body, F.array(_segment(F.lit(END), no)))

    convs = convs.select(
        "conv", F.size(start).alias("n_blocks"), F.flatten(F.transform(start, block)).alias("segments")
    )
    whole = F.array_join(F.transform("segments", lambda s: s["text"]), "")
    return convs.select(F.col("conv").alias(conv_col), "n_blocks", "segments", whole.alias("formatted"))


def read_turns(formatted: Column) -> Column:
    """The turns (role, text) of a formatted conversation."""
    cut = F.split(formatted, _quoted(END))
    blocks = F.slice(cut, F.lit(1), F.size(cut) - 1)

    def turns(block: Column) -> Column:
        parts = F.split(block, _quoted(BODY))
        role = unescaped(F.substring(F.get(parts, F.lit(0)), len(ROLE) + 1, 2**31 - 1))
        texts = F.split(F.get(parts, F.lit(1)), _quoted(MORE))
        return F.transform(texts, lambda x: F.struct(role.alias("role"), unescaped(x).alias("text")))

    return F.flatten(F.transform(blocks, turns))


def learned_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    own = F.filter(segments, lambda s: s["loss"])
    return F.array_join(F.transform(own, lambda s: unescaped(s["text"])), "")
