"""Chat formatting by rotating a dialogue through the perspective of every participant."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tapflow.llm.order import in_global_order

# Fixed values of the rendered format.
OPEN, CLOSE, END = "<|", "|>\n", "<|end|>\n"
ASSISTANT, USER, SYSTEM = "assistant", "user", "system"
NOBODY = "unknown"


def _head(speaks: Column, role: Column) -> Column:
    """Header of a turn: the assistant, the system, or a named user."""
    name = F.concat(F.lit(f"{USER} name="), role)
    kind = F.when(speaks, ASSISTANT).when(role == SYSTEM, SYSTEM).otherwise(name)
    return F.concat(F.lit(OPEN), kind, F.lit(CLOSE))


def rotated(turns: DataFrame, turns_per_part: int | None = None) -> DataFrame:
    """Render each dialogue once per participant, with that speaker as the assistant.

    All other participants are users by name; system turns stay system turns. The mask
    covers what the assistant says, its end marker included. Turns are ordered by turn,
    role and text (nulls first), so ties and repeated rows keep a fixed place. A dialogue is
    one row per speaker, however long; where its text would outgrow a row (2 GB), ask for
    parts of ``turns_per_part`` turns, each rendered by itself. Texts and names are taken as
    they are: one that holds a marker such as ``<|end|>`` is not escaped. A null role is the participant ``unknown``, a null text is empty,
    rows without conv_id form one dialogue; a dialogue of system turns alone has no
    perspective and gives no rows.

    Result, one row per dialogue, part and speaker: conv_id, part, speaker, n_turns,
    text, mask (array of start and end in characters, half-open).
    """
    rows = turns.select(
        "conv_id", "turn", F.coalesce("role", F.lit(NOBODY)).alias("role"), F.coalesce("text", F.lit("")).alias("content"),
    )
    placed = in_global_order(rows, ["conv_id", "turn", "role", "content"], "at")
    begins = placed.groupBy(F.col("conv_id").alias("of")).agg(F.min("at").alias("begin"))
    speakers = placed.where(F.col("role") != SYSTEM).select(F.col("conv_id").alias("by"), F.col("role").alias("speaker")).distinct()
    seen = placed.join(begins, F.col("conv_id").eqNullSafe(F.col("of"))).join(speakers, F.col("conv_id").eqNullSafe(F.col("by")))
    place = F.col("at") - F.col("begin")
    speaks = F.col("role") == F.col("speaker")
    part = F.lit(0) if turns_per_part is None else F.floor(place / turns_per_part)
    head, body = _head(speaks, F.col("role")), F.concat("content", F.lit("\n" + END))
    said = seen.select("conv_id", "speaker", part.cast("long").alias("part"), place.alias("place"), head.alias("head"), body.alias("body"), speaks.alias("speaks"))
    upto = Window.partitionBy("conv_id", "part", "speaker").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.char_length("head") + F.char_length("body")).over(upto)
    measured = said.withColumn("end", end).select(
        "conv_id", "part", "speaker", F.struct(
            "place", F.concat("head", "body").alias("text"),
            F.when(F.col("speaks"), F.struct((F.col("end") - F.char_length("body")).alias("start"), "end")).alias("span"),
        ).alias("turn"),
    )
    parts = measured.groupBy("conv_id", "part", "speaker").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    text = F.array_join(F.transform("turns", lambda x: x["text"]), "")
    mask = F.filter(F.transform("turns", lambda x: x["span"]), lambda x: x.isNotNull())
    return parts.select("conv_id", "part", "speaker", F.size("turns").cast("long").alias("n_turns"), text.alias("text"), mask.alias("mask"))
