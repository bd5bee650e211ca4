"""Hybrid length analysis: characters first, exact counts only near the limit."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tuneframe.functions.templates import ChatTemplate, get_template
from tuneframe.functions.text import (
    BORDERLINE,
    TOKEN_PATTERN,
    LengthLimits,
    count_tokens,
    estimate_from_chars,
    estimate_tokens,
    length_zone,
    token_array,
    token_count,
)
from tuneframe.plans.selection import value_at
from tuneframe.session import settle


def add_lengths(df: DataFrame, limits: LengthLimits, text: str = "text", pattern: str = TOKEN_PATTERN) -> DataFrame:
    """Add ``estimated_length``, ``zone`` and ``length``.

    ``length`` is the estimate outside the borderline zone and the exact count in it;
    the count sits in a CASE branch and is not evaluated for the other rows.
    """
    est = df.withColumn("estimated_length", estimate_tokens(F.col(text)))
    zoned = est.withColumn("zone", length_zone(F.col("estimated_length"), limits))
    return zoned.withColumn("length", final_length(F.col("zone"), count_tokens(F.col(text), pattern)))


def final_length(zone: Column, exact: Column) -> Column:
    return F.when(zone == BORDERLINE, exact).otherwise(F.col("estimated_length"))


def add_lengths_with(
    df: DataFrame, limits: LengthLimits, counter: Callable[[pd.Series], pd.Series], text: str = "text"
) -> DataFrame:
    """The same with a tokenizer of the caller's, given Arrow batches of texts.

    Spark evaluates a Python function in a CASE branch for every row, so the text of a
    row that is not borderline is sent as null, and only the others are counted.
    """

    @F.pandas_udf("int")
    def exact(texts: pd.Series) -> pd.Series:
        known = texts.dropna()
        counts = counter(known).astype("Int32") if len(known) else pd.Series(dtype="Int32")
        return counts.reindex(texts.index)

    est = df.withColumn("estimated_length", estimate_tokens(F.col(text)))
    zoned = est.withColumn("zone", length_zone(F.col("estimated_length"), limits))
    near = F.when(F.col("zone") == BORDERLINE, F.col(text))
    return zoned.withColumn("length", F.coalesce(exact(near), F.col("estimated_length")))


def conversation_lengths(
    turns: DataFrame,
    limits: LengthLimits,
    template: str | ChatTemplate = "chatml",
    conv: str = "conv_id",
    role: str = "role",
    text: str = "text",
    turn: str = "turn",
) -> DataFrame:
    """Lengths of rendered conversations straight from their turns.

    Characters and tokens of a rendered conversation are the sums over its messages
    (templates part messages, see ``ChatTemplate``). So only numbers are shuffled, they
    are added up before the shuffle, and no conversation is gathered in one place.
    A turn too long for any borderline conversation is not tokenised. Lengths are 64-bit,
    as a conversation may be longer than any text in one row. ``turn`` is looked at for families
    alone that put system texts into user turns.
    """
    shape = get_template(template)
    message = (F.col(role), F.col(text))
    order = [turn] if shape.system_in_user else []
    chars = turns.select(conv, role, text, *order, shape.piece_chars(*message).alias("__chars"))
    tokens = F.when(F.col("__chars") <= 4 * limits.upper + 3, shape.piece_tokens(*message))
    sums = chars.groupBy(conv).agg(
        F.sum("__chars").alias("__chars"),
        F.sum(tokens).alias("__tokens"),
        F.bool_or(F.col("__chars").isNull()).alias("__broken"),
        shape.loose_system(F.col(role), F.col(turn)).alias("__loose"),
    )
    loose = lambda more: F.when(F.col("__loose"), more).otherwise(0)
    total = F.when(F.col("__broken"), 0).otherwise(F.col("__chars") + len(shape.opening) + loose(shape.loose_chars))
    return (
        sums.withColumn("estimated_length", estimate_from_chars(total))
        .withColumn("zone", length_zone(F.col("estimated_length"), limits))
        .withColumn("length", final_length(F.col("zone"), F.col("__tokens") + token_count(shape.opening) + loose(shape.loose_tokens)))
        .select(conv, total.alias("chars"), "estimated_length", "zone", "length")
    )


def filter_length(df: DataFrame, limits: LengthLimits) -> DataFrame:
    return df.filter(F.col("length") <= limits.max_seq_length)


def length_counts(lengths: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Samples ``n`` and ``borderline`` ones of each length, written to the shared folder.

    Counting by length first leaves one row per distinct length, spread over the
    cluster whatever the share of a group. They are read several times, the texts once.
    """
    counts = lengths.groupBy(*by, "length").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("zone") == BORDERLINE).alias("borderline")
    )
    return settle(counts)


def with_upper_median(counts: DataFrame, sums: Sequence[Column], by: Sequence[str] = ()) -> DataFrame:
    """``sums`` over the counts, ``avg_length`` and ``median_length``, the element at total // 2 of the ascending lengths.

    The median of a group comes from ``value_at``; its row and the one of the sums are put
    together by an aggregation of two rows a group, so no join has to pair them.
    """
    total = F.sum(F.when(F.col("length").isNotNull(), F.col("n")))
    mean = F.coalesce(F.sum(F.col("length") * F.col("n")) / total, F.lit(0.0)).alias("avg_length")
    summed = counts.groupBy(*by).agg(*sums, mean)
    median = value_at(counts, lambda size: F.floor(size / 2), "length", by=by, name="median_length")
    median = median.withColumn("median_length", F.col("median_length").cast(counts.schema["length"].dataType))
    both = summed.unionByName(median, allowMissingColumns=True)
    merged = [F.max(c).alias(c) for c in summed.columns if c not in by]
    return both.groupBy(*by).agg(*merged, F.coalesce(F.max("median_length"), F.lit(0)).alias("median_length"))


def length_stats(lengths: DataFrame, limits: LengthLimits, by: Sequence[str] = ()) -> DataFrame:
    """Totals of the length check, with a higher limit to use where over 20% are too long."""
    zero = F.lit(0)
    total = F.coalesce(F.sum("n"), zero)
    too_long = F.coalesce(F.sum(F.when(F.col("length") > limits.max_seq_length, F.col("n"))), zero)
    borderline = F.coalesce(F.sum("borderline"), zero)
    share = lambda part: F.coalesce(F.try_divide(part * 100.0, total), F.lit(0.0))
    sums = [
        total.alias("total"),
        F.coalesce(F.max("length"), zero).alias("max_length"),
        too_long.alias("too_long"),
        share(too_long).alias("too_long_pct"),
        borderline.alias("borderline"),
        share(borderline).alias("borderline_pct"),
        F.when(too_long > total * 0.2, F.max("length")).alias("suggested_max_length"),
    ]
    columns = ["total", "max_length", "avg_length", "median_length", "too_long", "too_long_pct", "borderline", "borderline_pct", "suggested_max_length"]
    return with_upper_median(length_counts(lengths, by), sums, by).select(*by, *columns)


def prep_metadata(
    df: DataFrame,
    limits: LengthLimits,
    dataset_name: str,
    preprocessing_date: str,
    text: str = "text",
    checked: bool = True,
) -> DataFrame:
    """One row describing a prepared dataset, from the rendered samples including empty ones."""
    usable = F.length(text) > 0
    tail = [
        F.lit(limits.max_seq_length).alias("max_seq_length"),
        F.lit(dataset_name).alias("dataset_name"),
        F.lit(preprocessing_date).alias("preprocessing_date"),
    ]
    if not checked:
        unknown = F.lit(None)
        counts = df.agg(F.count(F.lit(1)).alias("original_samples"), F.count_if(usable).alias("valid_samples"))
        return counts.select(
            "*",
            unknown.cast("int").alias("max_length"),
            unknown.cast("double").alias("avg_length"),
            unknown.cast("int").alias("median_length"),
            F.lit(0).cast("bigint").alias("filtered_count"),
            *tail,
        )
    lengths = add_lengths(df, limits, text).select("zone", F.when(usable, F.col("length")).alias("length"))
    part = lambda condition: F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0))
    fits = F.col("length") <= limits.max_seq_length
    sums = [
        F.coalesce(F.sum("n"), F.lit(0)).alias("original_samples"),
        part(fits).alias("valid_samples"),
        F.coalesce(F.max("length"), F.lit(0)).alias("max_length"),
        part(~fits).alias("filtered_count"),
    ]
    stats = with_upper_median(length_counts(lengths), sums)
    return stats.select("original_samples", "valid_samples", "max_length", "avg_length", "median_length", "filtered_count", *tail)


def truncate_to(df: DataFrame, max_tokens: int, text: str = "text", pattern: str = TOKEN_PATTERN) -> DataFrame:
    """Replace ``text`` by ``tokens``, at most the first ``max_tokens`` of it.

    For the default pattern the text is cut behind its last token first, by a repetition
    that stops there and never goes back, so what follows is not split into tokens.
    """
    body = F.col(text)
    if pattern == TOKEN_PATTERN:
        body = F.regexp_extract(body, rf"^(?:[ \t\r\n]*+(?:[A-Za-z0-9]++|[^A-Za-z0-9 \t\r\n])){{0,{max_tokens}}}+", 0)
    return df.withColumn("tokens", F.slice(token_array(body, pattern), 1, max_tokens)).drop(text)
