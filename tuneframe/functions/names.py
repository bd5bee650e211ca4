"""Names derived from model and dataset identifiers, and the parts of backup names."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tuneframe.functions.scalars import fixed_point

# The first fragment found in a lower-cased model name decides the
# chat template, so longer fragments stand before the ones they contain.
TEMPLATE_BY_FRAGMENT = (
    ("llama-3.2", "llama-3.1"),
    ("llama-3.1", "llama-3.1"),
    ("llama-3", "llama3"),
    ("llama3", "llama3"),
    ("llama-2", "llama"),
    ("llama2", "llama"),
    ("qwen3", "qwen3"),
    ("qwen2.5", "qwen-2.5"),
    ("qwen-2.5", "qwen-2.5"),
    ("qwen2", "qwen-2"),
    ("qwen-2", "qwen-2"),
    ("phi", "phi-3"),
    ("gemma-3", "gemma-3"),
    ("gemma3", "gemma-3"),
    ("gemma-2", "gemma2"),
    ("gemma2", "gemma2"),
    ("gemma", "gemma"),
    ("mistral", "mistral"),
)
DEFAULT_TEMPLATE = "chatml"

# Sizes in a model name and the memory class they fall in.
SIZE_CLASSES = {
    "1.5-2GB": (1.5, 1.7),
    "2-3GB": (2.0,),
    "4-5GB": (3.0, 4.0),
    "7-9GB": (7.0,),
    "13-16GB": (13.0,),
}


def last_segment(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def author(path: Column) -> Column:
    """The part before the first slash, ``Unknown`` where there is none."""
    return F.when(path.contains("/"), F.element_at(F.split(path, "/"), 1)).otherwise("Unknown")


def dataset_slug(name: Column) -> Column:
    return F.replace(F.lower(last_segment(name)), F.lit("_"), F.lit("-"))


def model_base(name: Column, drop: Sequence[str] = ()) -> Column:
    """Last path segment without the packaging fragments in ``drop``, taken out in turn."""
    base = last_segment(name)
    for fragment in drop:
        base = F.replace(base, F.lit(fragment), F.lit(""))
    return base


def output_name(wanted: Column, model: Column, dataset: Column, drop: Sequence[str] = ()) -> Column:
    """``wanted``, or model and dataset joined where it is missing, empty or ``auto``."""
    derived = F.concat(model_base(model, drop), F.lit("-"), dataset_slug(dataset))
    return F.when(F.coalesce(wanted, F.lit("")).isin("", "auto"), derived).otherwise(wanted)


def template_for_model(name: Column) -> Column:
    lowered = F.lower(name)
    chosen = F
    for fragment, template in TEMPLATE_BY_FRAGMENT:
        chosen = chosen.when(lowered.contains(fragment), template)
    return chosen.otherwise(DEFAULT_TEMPLATE)


def model_size_class(name: Column) -> Column:
    """Memory class of the first ``<number>B`` that starts a name part; else null."""
    size = F.try_to_number(F.regexp_extract(name, r"(^|[-_])([0-9]+(\.[0-9]+)?)B", 2), F.lit("999.99"))
    chosen = F
    for label, sizes in SIZE_CLASSES.items():
        chosen = chosen.when(size.cast("double").isin(*sizes), label)
    return chosen.otherwise(F.lit(None).cast("string"))


def plain_number(value: Column) -> Column:
    """A double with its shortest digits: plain from 0.0001 on, as ``3e-05`` below."""
    text = value.cast("double").cast("string")
    digits = F.regexp_replace(F.regexp_extract(text, r"^([0-9.]+)E-", 1), r"\.0$", "")
    power = F.regexp_extract(text, r"E-([0-9]+)$", 1).try_cast("int")
    plain = F.concat(F.lit("0."), F.repeat(F.lit("0"), power - 1), F.replace(digits, F.lit("."), F.lit("")))
    tiny = F.concat(digits, F.lit("e-"), F.lpad(power.cast("string"), 2, "0"))
    return F.when(~text.contains("E-"), text).when(power <= 4, plain).otherwise(tiny)


def backup_name(date: Column, rank: Column, rate: Column, loss: Column) -> Column:
    """``<date>_rank<r>_lr<lr>_loss<loss>``; a spaced date is packed, gaps say ``unknown``."""
    unknown = F.lit("unknown")
    packed = F.substring(F.translate(date, " :-", "_"), 1, 15)
    stamp = F.when(date.contains(" "), packed).otherwise(F.coalesce(date, F.lit("")))
    return F.concat(
        stamp,
        F.lit("_rank"),
        F.coalesce(rank.cast("string"), unknown),
        F.lit("_lr"),
        F.coalesce(plain_number(rate), unknown),
        F.lit("_loss"),
        F.when(loss.isNull(), unknown).otherwise(fixed_point(loss, 4)),
    )


def backup_parts(name: Column) -> Column:
    """Date, time, rank, rate and loss of a backup name; a part not found is ``unknown``."""
    unknown = F.lit("unknown")
    date = F.substring_index(name, "_", 1)
    time = F.substring_index(F.substring_index(name, "_", 2), "_", -1)

    def spread(part: Column, first: int, joint: str) -> Column:
        cut = F.concat_ws(joint, part.substr(1, first), part.substr(first + 1, 2), part.substr(first + 3, 2))
        return F.when(name.contains("_") & (F.length(part) == first + 4), cut).otherwise(unknown)

    parts = F.split(name, "_")
    behind = F.slice(parts, 3, F.greatest(F.size(parts) - 2, F.lit(0)))

    def last_with(tag: str) -> Column:
        found = F.try_element_at(F.filter(behind, lambda part: part.startswith(tag)), F.lit(-1))
        return F.coalesce(F.replace(found, F.lit(tag), F.lit("")), unknown)

    return F.struct(
        spread(date, 4, "-").alias("date"),
        spread(time, 2, ":").alias("time"),
        last_with("rank").alias("rank"),
        last_with("lr").alias("lr"),
        last_with("loss").alias("loss"),
    )
