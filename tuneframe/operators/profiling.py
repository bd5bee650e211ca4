"""Reasoning detection and the match of model and data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tuneframe.functions.text import REASONING_MARKERS, has_reasoning

SAMPLE_ROWS = 50
REASONING_SHARE = 0.2


def flag_reasoning(df: DataFrame, text: str = "text", markers: Sequence[str] = REASONING_MARKERS) -> DataFrame:
    return df.withColumn("has_reasoning", has_reasoning(F.col(text), markers))


def flag_reasoning_messages(
    df: DataFrame, column: str = "messages", markers: Sequence[str] = REASONING_MARKERS
) -> DataFrame:
    """True for samples with a marker in any message."""
    return df.withColumn("has_reasoning", F.exists(column, lambda m: has_reasoning(m["content"], markers)))


def flag_reasoning_turns(
    turns: DataFrame, conv: str = "conv_id", text: str = "text", markers: Sequence[str] = REASONING_MARKERS
) -> DataFrame:
    """The same per conversation given as turns; flags are combined before the shuffle."""
    return (
        turns.select(conv, has_reasoning(F.col(text), markers).alias("flag"))
        .groupBy(conv)
        .agg(F.bool_or("flag").alias("has_reasoning"))
    )


def _share(flag: str = "has_reasoning") -> list[Column]:
    share = F.avg(F.col(flag).cast("int"))
    return [
        F.count(F.lit(1)).alias("sampled"),
        F.count_if(flag).alias("reasoning_samples"),
        share.alias("reasoning_share"),
        F.coalesce(share > REASONING_SHARE, F.lit(False)).alias("is_reasoning"),
    ]


def reasoning_share(
    df: DataFrame,
    order_key: str,
    n: int = SAMPLE_ROWS,
    text: str = "text",
    markers: Sequence[str] = REASONING_MARKERS,
) -> DataFrame:
    """Share of marked samples among the first ``n`` by ``order_key``.

    The sample is the feature: a top-n over key and text, kept per task before merging.
    """
    return flag_reasoning(df.orderBy(order_key).limit(n), text, markers).agg(*_share())


def reasoning_share_by(
    df: DataFrame, by: Sequence[str], text: str = "text", markers: Sequence[str] = REASONING_MARKERS
) -> DataFrame:
    """The same over all rows of each dataset."""
    return flag_reasoning(df, text, markers).groupBy(*by).agg(*_share())


def compatibility(model_is_reasoning: Column, data_is_reasoning: Column, supports_switch: Column) -> Column:
    """What to do for a model and a dataset of the given kinds."""
    return (
        F.when(
            model_is_reasoning & ~data_is_reasoning,
            F.when(supports_switch, "disable_thinking").otherwise("use_chatml"),
        )
        .when(~model_is_reasoning & data_is_reasoning, "use_reasoning_model")
        .when(model_is_reasoning, "ok_reasoning_template")
        .otherwise("ok_standard_template")
    )
