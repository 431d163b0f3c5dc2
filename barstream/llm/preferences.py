"""Preference pairs as one prompt and two masked completions, in DataFrame functions only.

The turns of a pair's two conversations are gathered by one shuffle on the pair. The longest common prefix of
turns (equal role and text) is rendered once; what follows on each side is rendered as its completion. A mask
gives the runs of a completion in characters: ``1:n`` for n characters to learn from (an assistant's text with its
end mark), ``0:n`` for n others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPENING = "<|im_start|>"
ENDING = "<|im_end|>\n"
LEARNT_ROLE = "assistant"


def _head(turn: Column) -> Column:
    return F.concat(F.lit(OPENING), turn["role"], F.lit("\n"))


def _body(turn: Column) -> Column:
    return F.concat(turn["text"], F.lit(ENDING))


def _render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(_head(t), _body(t))), "")


def _mask(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(
        F.lit("0:"), F.length(_head(t)), F.when(t["role"] == LEARNT_ROLE, ",1:").otherwise(",0:"),
        F.length(_body(t)))), ",")


def preference_format(turns: DataFrame, pair_col: str = "pair_id", side_col: str = "side") -> DataFrame:
    """One row per pair that has both sides: pair, n_prefix_turns, prompt, chosen, rejected, chosen_mask,
    rejected_mask.

    ``turns`` has pair, side ('chosen' or 'rejected'), turn, role, text. Turns are ordered by turn, role, text;
    a null turn number comes first, null roles and texts are empty, repeated rows count once. Rows with a null
    pair or another side belong to no pair, a pair without turns on one side is left out, an empty table gives
    no rows. If one side is a prefix of the other its completion is empty, with an empty mask. Other columns are
    not read.
    """
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    side = lambda name: F.sort_array(F.collect_set(F.when(F.col(side_col) == name, turn)))
    pairs = (turns.where(F.col(pair_col).isNotNull()).groupBy(pair_col)
             .agg(side("chosen").alias("c"), side("rejected").alias("r"))
             .where((F.size("c") > 0) & (F.size("r") > 0)))
    shorter = F.least(F.size("c"), F.size("r"))
    same = lambda i: ((F.get("c", i)["role"] == F.get("r", i)["role"])
                      & (F.get("c", i)["text"] == F.get("r", i)["text"]))
    prefix = F.coalesce(F.array_min(F.filter(F.sequence(F.lit(0), shorter - 1), lambda i: ~same(i))), shorter)
    split = pairs.withColumn("n", prefix).select(
        pair_col, F.col("n").cast("long").alias("n_prefix_turns"), F.slice("c", F.lit(1), F.col("n")).alias("p"),
        F.slice("c", F.col("n") + 1, F.size("c")).alias("c"), F.slice("r", F.col("n") + 1, F.size("r")).alias("r"))
    return split.select(pair_col, "n_prefix_turns", _render(F.col("p")).alias("prompt"),
                        _render(F.col("c")).alias("chosen"), _render(F.col("r")).alias("rejected"),
                        _mask(F.col("c")).alias("chosen_mask"), _mask(F.col("r")).alias("rejected_mask"))


def swapped_answers(conversations: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """Preference turns from plain conversations: each one is chosen; rejected is the same up to its last
    assistant turn, which is answered with the last assistant turn of the neighbour (id with its lowest bit
    flipped). Conversations without an assistant turn or without such a neighbour get no rejected side."""
    turns = conversations.select(F.col(conv_col).alias("pair_id"), "turn", "role", "text")
    last = (turns.where((F.col("role") == LEARNT_ROLE) & F.col("turn").isNotNull()).groupBy("pair_id")
            .agg(F.max(F.struct("turn", "text")).alias("last")))
    other = last.select(F.col("pair_id").bitwiseXOR(F.lit(1)).alias("pair_id"), F.col("last.text").alias("text"))
    ends = last.select("pair_id", F.col("last.turn").alias("turn")).join(other, "pair_id")
    before = turns.join(ends.select("pair_id", F.col("turn").alias("end")), "pair_id").where("turn < end").drop("end")
    rejected = before.unionByName(ends.withColumn("role", F.lit(LEARNT_ROLE)))
    return (turns.withColumn("side", F.lit("chosen"))
            .unionByName(rejected.withColumn("side", F.lit("rejected"))))
