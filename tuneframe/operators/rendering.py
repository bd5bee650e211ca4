"""Messages to text, and the removal of samples that could not be rendered."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tuneframe.functions.names import template_for_model
from tuneframe.functions.templates import TEMPLATES, ChatTemplate, get_template, without_thinking


class NoSamplesLeft(ValueError):
    """Every sample was dropped."""


def computed_once(df: DataFrame, column: str) -> DataFrame:
    """Keep the expression of a column from being copied into filters that follow.

    Spark moves a filter below a projection by putting the expression in the place of
    its name, so that each mention computes it again. It cannot do so below a generator.
    """
    order = df.columns
    return df.withColumn(column, F.explode(F.array(column))).select(*order)


def select_template(
    models: DataFrame, name: str = "model_name", known: DataFrame | None = None, own: str | None = None
) -> DataFrame:
    """Add ``template``: the model's own one, else the ``known`` map, else the name pattern.

    ``known(model_name, known_template)`` has one row per model.
    """
    choices: list[Column] = []
    if own:
        choices.append(F.col(own))
    if known is not None:
        keyed = known.select(F.col("model_name").alias(name), "known_template")
        models = models.join(keyed, name, "left")
        choices.append(F.col("known_template"))
    out = models.withColumn("template", F.coalesce(*choices, template_for_model(F.col(name))))
    return out.drop("known_template")


def render_chat(df: DataFrame, template: str | ChatTemplate = "chatml") -> DataFrame:
    """Replace ``messages`` by ``text``, without a prompt for a next answer."""
    text = get_template(template).render(F.col("messages"))
    return computed_once(df.withColumn("text", text).drop("messages"), "text")


def render_switched(
    df: DataFrame, template: str | ChatTemplate, action: str = "action", fallback: str | ChatTemplate = "chatml"
) -> DataFrame:
    """Render with ``template``, with its thinking switched off, or with the fallback, as the action says.

    Adds ``thinking``: whether the template's reasoning markup stays on. The actions are
    those of ``compatibility``; without a switch in the template the fallback takes the
    place of turning reasoning off.
    """
    messages = F.col("messages")
    text = (
        F.when(F.col(action) == "use_chatml", get_template(fallback).render(messages))
        .when(F.col(action) == "disable_thinking", without_thinking(template).render(messages))
        .otherwise(get_template(template).render(messages))
    )
    thinking = ~F.col(action).isin("use_chatml", "disable_thinking")
    return computed_once(df.withColumns({"text": text, "thinking": thinking}).drop("messages"), "text")


def render_by_template(df: DataFrame, template: str = "template", more: Mapping[str, ChatTemplate] | None = None) -> DataFrame:
    """Replace ``messages`` by ``text`` in the markup each row's template column names.

    ``more`` adds markup by name. A name without markup gives an empty text, as a
    message that cannot be rendered does.
    """
    known = {**TEMPLATES, **(more or {})}
    alike: dict[tuple, list[str]] = {}
    for name, found in known.items():
        alike.setdefault((tuple(found.roles.items()), found.opening, found.strip, found.system_in_user), []).append(name)
    text = F
    for names in alike.values():
        text = text.when(F.col(template).isin(*names), known[names[0]].render(F.col("messages")))
    return computed_once(df.withColumn("text", text.otherwise("")).drop("messages"), "text")


def drop_empty(df: DataFrame, text: str = "text") -> DataFrame:
    return df.filter(F.length(text) > 0)


def empty_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """Samples before and after dropping empty ones, in one pass."""
    kept = F.count_if(F.length(text) > 0)
    return df.agg(
        F.count(F.lit(1)).alias("original_samples"),
        kept.alias("kept_samples"),
        (F.count(F.lit(1)) - kept).alias("dropped_samples"),
    )


def require_samples(counts: DataFrame, column: str = "kept_samples") -> int:
    """The number of samples left; raises where there is none."""
    left = counts.first()[column]
    if not left:
        raise NoSamplesLeft("all samples were dropped; check the template against the data format")
    return left
