"""Range and choice rules over a table of run settings, and lookups in nested settings."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tuneframe.functions.scalars import is_duration
from tuneframe.operators.artifacts import OUTPUT_FORMATS


@dataclass(frozen=True)
class Rule:
    """A condition a value has to meet; a missing value meets every rule."""

    column: str
    name: str
    low: float | None = None
    high: float | None = None
    above: float | None = None
    choices: tuple[str, ...] = ()
    each: bool = False
    duration: bool = False

    def broken(self) -> Column:
        value = F.col(self.column)
        if self.each:
            return F.exists(value, lambda v: ~v.isin(*self.choices))
        bad = F.lit(False)
        if self.duration:
            bad = bad | (value.isNotNull() & ~is_duration(value))
        if self.above is not None:
            bad = bad | (value <= self.above)
        if self.low is not None:
            bad = bad | (value < self.low)
        if self.high is not None:
            bad = bad | (value > self.high)
        if self.choices:
            bad = bad | ~value.isin(*self.choices)
        return F.coalesce(bad, F.lit(False))


# The permitted settings of a run.
OPTIMIZERS = ("adamw_8bit", "adamw_torch", "sgd", "adafactor")
BACKENDS = ("ollama", "vllm", "transformers")
RULES = (
    Rule("lora_rank", "positive", above=0),
    Rule("lora_alpha", "positive", above=0),
    Rule("lora_dropout", "fraction", low=0, high=1),
    Rule("batch_size", "positive", above=0),
    Rule("gradient_accumulation_steps", "positive", above=0),
    Rule("learning_rate", "positive", above=0),
    Rule("optimizer", "choice", choices=OPTIMIZERS),
    Rule("warmup_ratio", "fraction", low=0, high=1),
    Rule("warmup_steps", "not negative", low=0),
    Rule("max_grad_norm", "positive", above=0),
    Rule("num_train_epochs", "positive", above=0),
    Rule("max_steps", "not negative", low=0),
    Rule("max_samples", "not negative", low=0),
    Rule("max_seq_length", "positive", above=0),
    Rule("logging_steps", "positive", above=0),
    Rule("save_steps", "positive", above=0),
    Rule("save_total_limit", "not negative", low=0),
    Rule("formats", "choice", choices=OUTPUT_FORMATS, each=True),
    Rule("max_tokens", "positive", above=0),
    Rule("eval_batch_size", "positive", above=0),
    Rule("backend", "choice", choices=BACKENDS),
    Rule("timeout", "duration", duration=True),
)


def config_violations(configs: DataFrame, *keys: str, rules: Sequence[Rule] = RULES) -> DataFrame:
    """One row per broken rule; rules on columns the table lacks are passed over.

    Rows are multiplied by rule numbers only; the texts are filled in for broken rules.
    """
    used = [rule for rule in rules if rule.column in configs.columns]
    numbers = F.array(*[F.when(rule.broken(), F.lit(i)) for i, rule in enumerate(used)])
    # The array is a column of its own: inside explode its lambdas would turn codegen off.
    numbered = configs.withColumn("__rules", numbers)
    broken = numbered.withColumn("__rule", F.explode("__rules")).filter(F.col("__rule").isNotNull())

    def by_rule(text: Callable[[Rule], Column]) -> Column:
        chosen = F
        for i, rule in enumerate(used):
            chosen = chosen.when(F.col("__rule") == i, text(rule))
        return chosen.otherwise(F.lit(None).cast("string"))

    shown = lambda rule: F.array_join(rule.column, ",") if rule.each else F.col(rule.column).cast("string")
    return broken.select(
        *keys,
        by_rule(lambda rule: F.lit(rule.column)).alias("field"),
        by_rule(lambda rule: F.lit(rule.name)).alias("rule"),
        by_rule(shown).alias("value"),
    )


def unknown_settings(documents: DataFrame, *keys: str, document: str = "document", known: Sequence[str] | None = None) -> DataFrame:
    """One row per name at the top of a JSON document of settings that no rule or ``known`` name has.

    A text that is no JSON object has no names.
    """
    names = list(known) if known is not None else sorted({rule.column for rule in RULES})
    found = documents.select(*keys, F.explode(F.json_object_keys(F.col(document))).alias("field"))
    return found.filter(~F.col("field").isin(*names)).withColumn("rule", F.lit("unknown"))


def get_path(document: Column, path: str, default: Any = None, data_type: str = "string") -> Column:
    """Value at a dotted path of a JSON document, or the default."""
    value = F.try_variant_get(F.try_parse_json(document), f"$.{path}", data_type)
    return F.coalesce(value, F.lit(default).cast(data_type))
