"""Preference pairs from conversations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MARK, END = "<|", "<|end|>\n"


def _turns(rows: DataFrame, side: str) -> DataFrame:
    """One row per pair: its turns in order, ties by role and text."""
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    ordered = F.transform(F.sort_array(F.collect_list(turn)), lambda t: F.struct(t.role.alias("role"), t.text.alias("text")))
    return rows.where(F.col("pair_id").isNotNull()).groupBy("pair_id").agg(ordered.alias(side))


def _render(turn: Column) -> Column:
    """``<|role|>``, a line break, the text and an end mark; marks inside a text or role are broken up."""
    safe = lambda c: F.replace(c, F.lit(MARK), F.lit("< |"))
    return F.concat(F.lit(MARK), safe(turn.role), F.lit("|>\n"), safe(turn.text), F.lit(END))


def preference_pairs(chosen: DataFrame, rejected: DataFrame) -> DataFrame:
    """Prompt and completions of paired conversations.

    Both inputs have ``pair_id, turn, role, text``.  The longest prefix of
    turns that both sides share (role and text equal) is rendered once as
    ``prompt``; what follows on either side is its completion.  Returns
    ``pair_id, shared_turns, prompt, chosen, rejected, chosen_mask,
    rejected_mask``: a mask is the completion's run lengths in characters with
    ``loss`` true on assistant turns only, and the lengths add up to the
    completion's.  A pair with one side only has an empty other side; equal
    sides give empty completions.  Null role or text: empty.  Turns are ordered
    by number, null first; equal numbers by role and text.  Rows without
    pair_id are left out.  Empty tables: empty.

    A conversation is one example and is rendered into one row, as it must be
    for its consumer; pairs meet by one shuffle on ``pair_id`` each.
    """
    both = _turns(chosen, "a").join(_turns(rejected, "b"), "pair_id", "full_outer")
    empty = F.array().cast("array<struct<role:string,text:string>>")
    both = both.select("pair_id", F.coalesce("a", empty).alias("a"), F.coalesce("b", empty).alias("b"))
    shorter = F.least(F.size("a"), F.size("b"))
    same = F.zip_with(F.slice("a", 1, shorter), F.slice("b", 1, shorter), lambda x, y: x == y)
    unlike = F.array_position(same, F.lit(False))
    both = both.withColumn("shared_turns", F.when(unlike > 0, unlike - 1).otherwise(shorter).cast("int"))
    text = lambda turns: F.array_join(F.transform(turns, _render), "")
    rest = lambda side: F.slice(side, F.col("shared_turns") + 1, F.size(side))
    mask = lambda turns: F.transform(turns, lambda t: F.struct(
        F.length(_render(t)).alias("chars"), (t.role == "assistant").alias("loss")))
    return both.select("pair_id", "shared_turns", text(F.slice("a", 1, F.col("shared_turns"))).alias("prompt"),
                       text(rest("a")).alias("chosen"), text(rest("b")).alias("rejected"),
                       mask(rest("a")).alias("chosen_mask"), mask(rest("b")).alias("rejected_mask"))


def swapped_replies(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Chosen and rejected sides for conversations that have no ratings.

    Chosen: a conversation up to its last assistant turn.  Rejected: the same
    with that turn's text taken from the conversation it is paired with, ids 2i
    and 2i + 1; without one, without that turn.  A conversation without an
    assistant turn is its own prompt.
    """
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("pair_id"), "turn", "role", "text")
    reply = (rows.where(F.col("role") == "assistant").groupBy("pair_id")
             .agg(F.max(F.struct("turn", F.coalesce("text", F.lit("")).alias("text"))).alias("last")))
    cut = rows.join(reply, "pair_id", "left")
    chosen = cut.where(F.col("last").isNull() | F.col("turn").isNull() | (F.col("turn") <= F.col("last.turn")))
    before = cut.where(F.col("last").isNull() | F.col("turn").isNull() | (F.col("turn") < F.col("last.turn")))
    names = ["pair_id", "turn", "role", "text"]
    other = reply.select(F.col("pair_id").bitwiseXOR(F.lit(1).cast("bigint")).alias("pair_id"),
                         F.col("last.text").alias("text"))
    swapped = reply.select("pair_id", "last.turn").join(other, "pair_id").select(
        "pair_id", "turn", F.lit("assistant").alias("role"), "text")
    return chosen.select(*names), before.select(*names).unionByName(swapped)
