"""Operator 2: multi-party dialogues, rendered once from the view of every participant.

For each participant the dialogue is rendered with that speaker as the assistant and all others as named users; system turns
stay system turns. The mask marks what a model is to learn: the text of the speaker's own turns and their end mark.

Turns of a dialogue are cut into parts of ``PART`` turn numbers before they are gathered, so a dialogue of any length is
rendered in pieces: the texts of its parts, in order, joined by nothing, are the whole rendering. Positions count code
points of the whole rendering; only the length of each part is needed to place the next.

Turns without a conversation id, role or turn number take no part. A null text is empty. Turns that repeat a number keep it and
follow each other by role and text, repeated rows included. A conversation without participants (system turns only) gives no rows.
Other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PART = 64
SYSTEM = "system"
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"


def perspectives(turns: DataFrame, part_turns: int = PART) -> DataFrame:
    """conv_id, speaker, part, n_turns, start (of the part), text, mask (start:end, joined by commas)."""
    known = turns.where("conv_id IS NOT NULL AND turn IS NOT NULL AND role IS NOT NULL").select(
        "conv_id", F.floor(F.col("turn") / part_turns).cast("bigint").alias("part"), "turn", "role",
        F.coalesce("text", F.lit("")).alias("text"),
    )
    speakers = known.where(F.col("role") != SYSTEM).select("conv_id", F.col("role").alias("speaker")).distinct()
    parts = known.groupBy("conv_id", "part").agg(
        F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns")
    )
    views = parts.join(speakers.hint("merge"), "conv_id")
    rendered = views.withColumn("pieces", F.transform("turns", lambda t: _piece(t, F.col("speaker"))))
    rendered = rendered.select(
        "conv_id", "speaker", "part", F.size("turns").cast("bigint").alias("n_turns"), "pieces",
        F.array_join(F.col("pieces.all"), "").alias("text"),
    )
    before = Window.partitionBy("conv_id", "speaker").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    placed = rendered.withColumn(
        "start", F.coalesce(F.sum(F.length("text").cast("bigint")).over(before), F.lit(0)).cast("bigint")
    )
    mask = F.array_join(_spans(F.col("pieces"), F.col("start")), ",")
    return placed.select("conv_id", "speaker", "part", "n_turns", "start", "text", mask.alias("mask"))


def _piece(turn: Column, speaker: Column) -> Column:
    """One rendered turn: all of it, its length, and the length of what the mask covers at its end."""
    role = turn["role"]
    own = role == speaker
    who = F.when(role == SYSTEM, SYSTEM).when(own, "assistant").otherwise(F.concat(F.lit("user name="), role))
    body = F.concat(turn["text"], F.lit(CLOSE))
    text = F.concat(F.lit(OPEN), who, F.lit("\n"), body)
    return F.struct(
        text.alias("all"),
        F.length(text).cast("bigint").alias("length"),
        F.when(own & (role != SYSTEM), F.length(body)).otherwise(0).cast("bigint").alias("learn"),
    )


def _spans(pieces: Column, start: Column) -> Column:
    """Masked spans of a part as text; it has a bounded number of turns."""
    empty = F.struct(start.alias("at"), F.array().cast("array<string>").alias("spans"))

    def step(done: Column, x: Column) -> Column:
        end = done["at"] + x["length"]
        span = F.concat_ws(":", (end - x["learn"]).cast("string"), end.cast("string"))
        spans = F.when(x["learn"] > 0, F.concat(done["spans"], F.array(span))).otherwise(done["spans"])
        return F.struct(end.alias("at"), spans.alias("spans"))

    return F.aggregate(pieces, empty, step, lambda done: done["spans"])
