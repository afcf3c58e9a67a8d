"""Operator 8 (native): preference formatting of chosen and rejected conversations.

``format_pairs`` takes two tables of turns that share a pair id.  Per pair it
finds the longest common prefix of turns (equal role and text), renders it once
as the prompt, and emits both remainders as completions in masked segments:
turn headers and turns of other roles are context (``train`` false), the text
of assistant turns with its end mark is learned (``train`` true).  Everything
is one aggregate per side, one join and array expressions; no Python runs.

A turn renders as ``<|im_start|>role\\ntext<|im_end|>\\n``; ``<|`` inside a role or
text is broken up (``< |``), so no text can forge a mark.

``rivals`` makes pairs out of plain conversations: chosen is the conversation
up to its last assistant turn, rejected the same with that reply replaced by
the last reply of the next conversation (id + 1), and without it if there is none.

Defined results: turns are ordered by turn (null first), role, text; a null
role is ``unknown``, a null text is empty; rows that repeat exactly are one turn;
rows with a null pair id belong to no pair and are dropped; a pair with one
side missing has an empty other side; equal sides give empty completions and
``usable`` false; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE, LEARNED = "<|im_start|>", "<|im_end|>", "assistant"


def _clean(c: Column) -> Column:
    return F.replace(c, F.lit("<|"), F.lit("< |"))


def turns(table: DataFrame, key: str = "pair_id") -> DataFrame:
    """(key, turns array<struct<turn, role, text>>) in conversation order."""
    turn = F.struct(F.col("turn"), F.coalesce(F.col("role"), F.lit("unknown")).alias("role"),
                    F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return (table.where(F.col(key).isNotNull()).groupBy(key)
            .agg(F.array_distinct(F.sort_array(F.collect_list(turn))).alias("turns")))


def _render(part: Column) -> Column:
    return F.array_join(F.transform(part, lambda t: F.concat(
        F.lit(OPEN), _clean(t["role"]), F.lit("\n"), _clean(t["text"]), F.lit(CLOSE + "\n"))), "")


def _segments(part: Column) -> Column:
    """Masked pieces of a completion; their texts joined are the rendered completion."""
    def pieces(t: Column) -> Column:
        learned = t["role"] == LEARNED
        return F.array(
            F.struct(F.concat(F.lit(OPEN), _clean(t["role"]), F.lit("\n")).alias("text"), F.lit(False).alias("train")),
            F.struct(F.concat(_clean(t["text"]), F.lit(CLOSE)).alias("text"), learned.alias("train")),
            F.struct(F.lit("\n").alias("text"), F.lit(False).alias("train")))
    return F.flatten(F.transform(part, pieces))


def format_pairs(chosen: DataFrame, rejected: DataFrame) -> DataFrame:
    """Turn tables (pair_id, turn, role, text) -> one row per pair."""
    return format_arrays(turns(chosen).withColumnRenamed("turns", "c")
                         .join(turns(rejected).withColumnRenamed("turns", "r"), "pair_id", "full"))


def format_arrays(pairs: DataFrame) -> DataFrame:
    """(pair_id, c, r: arrays of turns) -> pair_id, prompt_turns, prompt, chosen,
    rejected, chosen_segments, rejected_segments, usable."""
    none = F.expr("cast(array() as array<struct<turn: bigint, role: string, text: string>>)")
    pairs = pairs.select("pair_id", F.coalesce("c", none).alias("c"), F.coalesce("r", none).alias("r"))
    same = F.zip_with("c", "r", lambda x, y: F.coalesce((x["role"] == y["role"]) & (x["text"] == y["text"]), F.lit(False)))
    # the first difference ends the prefix; zip_with pads the shorter side with nulls
    at = F.array_position(same, F.lit(False))
    n = F.when(at > 0, at - 1).otherwise(F.size("c")).cast("int")
    pairs = pairs.withColumn("n", n).select(
        "pair_id", F.col("n").cast("long").alias("prompt_turns"), F.slice("c", F.lit(1), F.col("n")).alias("p"),
        F.slice("c", F.col("n") + 1, F.size("c")).alias("c"), F.slice("r", F.col("n") + 1, F.size("r")).alias("r"))
    return pairs.select(
        "pair_id", "prompt_turns", _render(F.col("p")).alias("prompt"), _render(F.col("c")).alias("chosen"),
        _render(F.col("r")).alias("rejected"), _segments(F.col("c")).alias("chosen_segments"),
        _segments(F.col("r")).alias("rejected_segments"), ((F.size("c") > 0) | (F.size("r") > 0)).alias("usable"))


def rivals(conversations: DataFrame) -> DataFrame:
    """(pair_id, c, r) for every conversation (see module text)."""
    rows = conversations.select(F.col("conv_id").alias("pair_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    donors = (rows.where((F.col("role") == LEARNED) & F.col("pair_id").isNotNull())
              .groupBy((F.col("pair_id") - 1).alias("pair_id"))
              .agg(F.max(F.struct("turn", F.coalesce("text", F.lit("")).alias("text")))["text"].alias("reply")))
    both = turns(rows).join(donors, "pair_id", "left")
    size = F.size("turns")
    last = size - F.array_position(F.transform(F.reverse("turns"), lambda t: t["role"]), F.lit(LEARNED)).cast("int") + 1
    both = both.withColumn("last", F.when(F.exists("turns", lambda t: t["role"] == LEARNED), last).otherwise(0))
    head, own = F.slice("turns", F.lit(1), F.greatest(F.col("last") - 1, F.lit(0))), F.element_at("turns", F.col("last"))
    swapped = F.struct(own["turn"].alias("turn"), own["role"].alias("role"), F.col("reply").alias("text"))
    none = F.col("last") == 0
    return both.select(
        "pair_id",
        F.when(none, F.col("turns")).otherwise(F.slice("turns", F.lit(1), F.col("last"))).alias("c"),
        F.when(none, F.col("turns")).when(F.col("reply").isNull(), head)
        .otherwise(F.concat(head, F.array(swapped))).alias("r"))


def mask_text(segments: Column) -> Column:
    """Compact mask: ``0:n`` or ``1:n`` characters, in order."""
    return F.array_join(F.transform(segments, lambda s: F.concat(
        F.when(s["train"], F.lit("1:")).otherwise(F.lit("0:")), F.length(s["text"]).cast("string"))), ",")
