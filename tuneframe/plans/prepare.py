"""From raw samples to checked training texts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tuneframe.functions.templates import ChatTemplate, get_template
from tuneframe.functions.text import LengthLimits, count_tokens, estimate_from_chars, length_zone
from tuneframe.operators.lengths import add_lengths, conversation_lengths, filter_length, final_length, length_stats
from tuneframe.operators.rendering import drop_empty, render_chat
from tuneframe.operators.standardize import canonical_role, to_messages


def prepare_samples(samples: DataFrame, limits: LengthLimits, template: str | ChatTemplate = "chatml") -> DataFrame:
    """Rows that hold a sample each, in any known format: one narrow stage, no shuffle."""
    texts = drop_empty(render_chat(to_messages(samples), template))
    return filter_length(add_lengths(texts, limits), limits)


def conversation_stats(turns: DataFrame, limits: LengthLimits, template: str | ChatTemplate = "chatml") -> DataFrame:
    """Length statistics of conversations given as turns; no text is shuffled."""
    lengths = conversation_lengths(canonical_turns(turns), limits, template)
    return length_stats(lengths.filter(F.col("chars") > 0), limits)


def canonical_turns(turns: DataFrame) -> DataFrame:
    return turns.withColumn("role", canonical_role(F.col("role")))


def prepare_turns(
    turns: DataFrame,
    limits: LengthLimits,
    template: str | ChatTemplate = "chatml",
) -> DataFrame:
    """Rendered texts within the limit, one row per conversation, from its turns.

    A text within the limit is short, so gathering it is safe. Conversations that cannot
    be kept, whatever their size, are found from sums over their turns and removed
    before any turns are brought together.
    """
    shape = get_template(template)
    message = (F.col("role"), F.col("text"))
    sized = canonical_turns(turns).withColumn("__chars", shape.piece_chars(*message))
    loose = F.when(shape.loose_system(F.col("role"), F.col("turn")), shape.loose_chars).otherwise(0)
    sums = sized.groupBy("conv_id").agg(
        F.sum("__chars").alias("chars"),
        F.bool_or(F.col("__chars").isNull()).alias("broken"),
        loose.alias("loose"),
    )
    lost = F.col("broken") | (estimate_from_chars(F.col("chars") + F.col("loose") + len(shape.opening)) > limits.upper)
    gone = sums.filter(lost).select(F.col("conv_id").alias("__lost"))
    rest = sized.join(gone, F.col("conv_id").eqNullSafe(F.col("__lost")), "left_anti")  # turns without conv_id are one conversation

    # What is left is short enough to be kept. The
    # filter works on sums; a text is put together where it is kept or borderline.
    grouped = rest.select("conv_id", "turn", "role", "__chars", shape.piece(*message).alias("piece")).groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("turn", "piece", "role"))).alias("__turns"),
        (F.sum("__chars") + loose + len(shape.opening)).alias("__chars"),
        F.bool_or(F.col("__chars").isNull()).alias("__broken"),
    )
    text = F.concat(F.lit(shape.opening), shape.join(F.col("__turns")))
    measured = (
        grouped.filter(~F.col("__broken"))
        .withColumn("text", text)
        .withColumn("estimated_length", estimate_from_chars(F.col("__chars")))
        .withColumn("zone", length_zone(F.col("estimated_length"), limits))
        .withColumn("length", final_length(F.col("zone"), count_tokens(F.col("text"))))
    )
    return filter_length(measured, limits).select("conv_id", "text", "estimated_length", "zone", "length")
