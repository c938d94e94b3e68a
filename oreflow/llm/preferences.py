"""Preference formatting of chosen and rejected conversations, with DataFrame functions only.

The longest common prefix of turns is the prompt and is rendered once; what follows on
either side is a completion, whose assistant turns are the targets. A turn number stands for
a position: the prefix ends before the least turn at which the two sides do not hold the
same roles and texts, as often. That takes two aggregates with map-side combine and no
window, so a conversation may have any number of turns; results are rows per turn.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oreflow.llm.common import quoted

START, END = "<|im_start|>", "<|im_end|>"


def _plain(name: str) -> Column:
    return F.replace(F.coalesce(F.col(name).cast("string"), F.lit("")), F.lit("<|"), F.lit("< |"))


def _head(role: str) -> Column:
    return F.concat(F.lit(START), _plain(role), F.lit("\n"))


def rendered(role: str, text: str) -> Column:
    """A turn between its marks; marks inside of it are broken by a space."""
    return F.concat(_head(role), _plain(text), F.lit(END + "\n"))


def preference_rows(
    chosen: DataFrame,
    rejected: DataFrame,
    pair: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """(``pair``, part, turn, copy, role, rendered, is_target, target_begin, target_end): the turns of each pair.

    ``part`` is prompt, chosen or rejected. The rows of a part stand in the order of turn,
    role, rendered and copy. ``is_target`` marks the assistant's turns of completions, on
    which a loss is taken; everything else is masked, and so is the turn's head: the loss is of
    the code points from ``target_begin`` up to ``target_end`` of ``rendered``, which are the
    text and its end mark. Both are null where all is masked. If one side is a prefix of the other
    it has no completion; equal sides are a prompt only. A null turn comes after all others;
    null roles and texts are equal to one another and rendered empty; turns that stand
    there repeatedly are rendered as often (``copy`` counts from 0). A null pair is a pair.
    Other columns are left out. No rows give no rows.
    """
    sides = [
        side.select(
            F.col(quoted(pair)).alias("pair"),
            F.col(quoted(turn)).cast("long").alias("turn"),
            F.col(quoted(role)).cast("string").alias("role"),
            F.col(quoted(text)).cast("string").alias("text"),
            F.lit(is_chosen).cast("long").alias("in_chosen"),
            F.lit(1 - is_chosen).cast("long").alias("in_rejected"),
        )
        for side, is_chosen in ((chosen, 1), (rejected, 0))
    ]
    turns = sides[0].unionAll(sides[1]).groupBy("pair", "turn", "role", "text")
    turns = turns.agg(F.sum("in_chosen").alias("in_chosen"), F.sum("in_rejected").alias("in_rejected"))
    order = F.coalesce("turn", F.lit((1 << 63) - 1))
    differing = turns.where("in_chosen != in_rejected").groupBy(F.col("pair").alias("of"))
    ends = differing.agg(F.min(order).alias("end"))
    joined = turns.join(ends, turns["pair"].eqNullSafe(ends["of"]), "left")
    shared = F.col("end").isNull() | (order < F.col("end"))
    parts = F.when(
        shared, F.array(F.struct(F.lit("prompt").alias("part"), F.col("in_chosen").alias("times")))
    ).otherwise(
        F.array(
            F.struct(F.lit("chosen").alias("part"), F.col("in_chosen").alias("times")),
            F.struct(F.lit("rejected").alias("part"), F.col("in_rejected").alias("times")),
        )
    )
    rows = joined.select("pair", "turn", "role", "text", F.explode(parts).alias("p")).where("p.times > 0")
    copies = F.explode(F.sequence(F.lit(0).cast("long"), F.col("p.times") - 1))
    rows = rows.select("pair", "turn", "role", "text", "p.part", copies.alias("copy"))
    target = (F.col("part") != "prompt") & F.coalesce(F.lower("role") == "assistant", F.lit(False))
    whole = rendered("role", "text")
    return rows.select(
        F.col("pair").alias(pair), "part", "turn", "copy", "role",
        whole.alias("rendered"), target.alias("is_target"),
        F.when(target, F.length(_head("role"))).cast("long").alias("target_begin"),
        F.when(target, F.length(whole) - 1).cast("long").alias("target_end"),
    )


def neighbours_as_rejected(conversations: DataFrame) -> DataFrame:
    """For each conversation its turns, with the last one's from the neighbour in its place.

    Neighbours are conversations 2k and 2k + 1. A conversation without one loses its last
    turn. Where several rows share the last turn's number, the neighbour's greatest by role
    and text takes the place of all.
    """
    last = conversations.where("conv_id IS NOT NULL AND turn IS NOT NULL").groupBy("conv_id")
    last = last.agg(F.max(F.struct("turn", "role", "text")).alias("last"))
    kept = conversations.join(
        last.select(F.col("conv_id").alias("of"), F.col("last.turn").alias("last_turn")),
        F.col("conv_id") == F.col("of"),
        "left",
    ).where("last_turn IS NULL OR turn IS NULL OR turn < last_turn")
    other = last.select(
        F.expr("conv_id - pmod(conv_id, 2) + 1 - pmod(conv_id, 2)").alias("of"), "last"
    )
    new = last.select("conv_id", F.col("last.turn").alias("turn")).join(other, F.col("conv_id") == F.col("of"))
    return kept.select("conv_id", "turn", "role", "text").unionAll(
        new.select("conv_id", "turn", "last.role", "last.text")
    )
