"""Preference pairs as one rendered prompt and two masked completions.

The turns that the chosen and the rejected conversation share from the start are the prompt, rendered
once; the turns after them are the two completions. A turn is rendered as ``<|im_start|>role\\ntext<|im_end|>\\n``. Only
what assistants say in a completion is trained on: of such a segment, characters from ``train_from`` on,
of all others none (``train_from`` is then the segment's length).

There is one row for each rendered turn, so a conversation of any length is never one value. The end of the
common prefix is the least turn that differs, a plain minimum by pair. All steps are DataFrame operations.

Turns are compared by number, role and text; a null role or text equals an empty one. Rows without a pair id or a
turn number have no place in a conversation and are left out. Of several rows for one turn the least (role, text) counts, so
repeated rows change nothing. A pair that only one side has gets an empty prompt and that side's completion; two equal
conversations are all prompt. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _turns(side: DataFrame, pair_col: str, name: str) -> DataFrame:
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = side.select(F.col(pair_col).alias("_pair"), F.col("turn").alias("_turn"), text("role").alias("r"), text("text").alias("t"))
    return rows.where("_pair IS NOT NULL AND _turn IS NOT NULL").groupBy("_pair", "_turn").agg(F.min(F.struct("r", "t")).alias(name))


def _segment(turn: Column, part: str, trained: bool) -> Column:
    head = F.concat(F.lit("<|im_start|>"), turn["r"], F.lit("\n"))
    body = F.concat(head, turn["t"], F.lit("<|im_end|>\n"))
    spoken = (turn["r"] == "assistant") if trained else F.lit(False)
    return F.struct(
        F.lit(part).alias("part"),
        turn["r"].alias("role"),
        body.alias("segment"),
        F.when(spoken, F.length(head)).otherwise(F.length(body)).alias("train_from"),
    )


def preference_segments(chosen: DataFrame, rejected: DataFrame, pair_col: str = "pair_id") -> DataFrame:
    """``(pair_id, part, turn, role, segment, train_from)`` with part prompt, chosen or rejected."""
    both = _turns(chosen, pair_col, "c").join(_turns(rejected, pair_col, "x"), ["_pair", "_turn"], "full")
    differs = F.when(~F.col("c").eqNullSafe(F.col("x")), F.col("_turn"))
    ends = both.groupBy("_pair").agg(F.min(differs).alias("_end"))
    rows = both.join(ends, "_pair")
    shared = F.col("_end").isNull() | (F.col("_turn") < F.col("_end"))
    prompt = F.array(_segment(F.col("c"), "prompt", False))
    completions = F.array_compact(
        F.array(
            F.when(F.col("c").isNotNull(), _segment(F.col("c"), "chosen", True)),
            F.when(F.col("x").isNotNull(), _segment(F.col("x"), "rejected", True)),
        )
    )
    made = rows.select("_pair", "_turn", F.explode(F.when(shared, prompt).otherwise(completions)).alias("s"))
    return made.select(F.col("_pair").alias(pair_col), "s.part", F.col("_turn").alias("turn"), "s.role", "s.segment", "s.train_from")


def broken_off(conversations: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """The same conversations with the last assistant turn cut to its first half: a plainly worse answer."""
    last = conversations.where("role = 'assistant'").groupBy(id_col).agg(F.max("turn").alias("_last"))
    text = F.expr("CASE WHEN turn = _last AND role = 'assistant' THEN left(text, int(floor(char_length(text) / 2))) ELSE text END")
    return conversations.join(last, id_col, "left").select(id_col, "turn", "role", text.alias("text"))
