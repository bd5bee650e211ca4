"""Inventory of model outputs: sizes, formats, clean-up plans and quantisations.

The table is ``artifacts(model, area, name, length)``, one row per file; ``depth`` 0
marks files directly in the area where a listing is recursive.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# File names worth keeping, by area.
KEEP: Mapping[str, tuple[str, ...]] = {
    "lora": (
        "adapter_config.json",
        "adapter_model.safetensors",
        "training_metrics.json",
        "loss_history.csv",
        "trainer_state.json",
        "training_params.yaml",
        "README.md",
        "*.md",
    ),
    "merged_16bit": (
        "model.safetensors",
        "model-*.safetensors",
        "config.json",
        "generation_config.json",
        "tokenizer.json",
        "tokenizer_config.json",
        "special_tokens_map.json",
        "Modelfile",
        "chat_template.json",
        "README.md",
        "*.md",
    ),
    "gguf": ("*.gguf", "Modelfile", "README.md", "*.md"),
}

# The file whose presence makes a format available.
FORMAT_MARKERS = {
    "lora": "adapter_config.json",
    "merged_16bit": "config.json",
    "merged_4bit": "config.json",
    "gguf": "*.gguf",
}
UPLOAD_MARKERS = {"lora": "adapter_config.json", "merged_16bit": "model.safetensors", "gguf": "*.gguf"}

# What a quantisation name says about quality.
QUANT_QUALITY = (
    ("Q2", "Smallest size, lower quality"),
    ("Q3", "Small size, moderate quality"),
    ("Q4", "Good balance (recommended)"),
    ("Q5", "Better quality, larger size"),
    ("Q6", "High quality"),
    ("Q8", "Very high quality, near original"),
    ("F16", "Full precision (largest)"),
    ("f16", "Full precision (largest)"),
)
PREFERRED_QUANT = "Q4_K_M"

# The output formats that can be asked for.
OUTPUT_FORMATS = (
    "gguf_f16",
    "gguf_f32",
    "gguf_q8_0",
    "gguf_q6_k",
    "gguf_q5_k_m",
    "gguf_q4_k_m",
    "gguf_q3_k_m",
    "gguf_q2_k",
    "merged_16bit",
    "merged_4bit",
)

GB = 1024.0**3
MB = 1024.0**2


def glob_regex(patterns: Sequence[str]) -> str:
    """One anchored regular expression for shell patterns with ``*``; all else is literal."""
    return "^(" + "|".join(".*".join(re.escape(part) for part in p.split("*")) for p in patterns) + ")$"


def matches(name: Column, *patterns: str) -> Column:
    return name.rlike(glob_regex(patterns))


def at_top(artifacts: DataFrame) -> Column:
    """Whether an item lies directly in its area; without a column ``depth`` all do."""
    return F.col("depth") == 0 if "depth" in artifacts.columns else F.lit(True)


def area_sizes(artifacts: DataFrame, pattern: str = "*") -> DataFrame:
    """Bytes of all files, and the number of those directly in the area that match ``pattern``, per model and area."""
    counted = at_top(artifacts) & matches(F.col("name"), pattern)
    return artifacts.groupBy("model", "area").agg(F.sum("length").alias("bytes"), F.count_if(counted).alias("files"))


def formats_available(artifacts: DataFrame, markers: Mapping[str, str] = FORMAT_MARKERS) -> DataFrame:
    """One flag per format, from markers directly in their area; models without any are left out."""
    top = at_top(artifacts)
    flags = {area: top & (F.col("area") == area) & matches(F.col("name"), marker) for area, marker in markers.items()}
    table = artifacts.groupBy("model").agg(*[F.bool_or(flag).alias(area) for area, flag in flags.items()])
    any_format = F.lit(False)
    for area in markers:
        any_format = any_format | F.col(area)
    return table.filter(any_format)


def cleanup_plan(
    artifacts: DataFrame, keep: Mapping[str, Sequence[str]] = KEEP, cache_dirs: Sequence[str] = ("__pycache__",)
) -> DataFrame:
    """Items that can go: files directly in a known area that match none of its patterns.

    Nothing below a directory of an area is listed. With a column ``is_dir``, directories named in ``cache_dirs`` go too and count no
    bytes; other directories stay. This is a plan; nothing is deleted.
    """
    keeps = F
    for area, patterns in keep.items():
        keeps = keeps.when(F.col("area") == area, matches(F.col("name"), *patterns))
    removable = ~keeps.otherwise(True)
    size = F.col("length")
    if "is_dir" in artifacts.columns:
        known = F.col("area").isin(*keep)
        removable = F.when(F.col("is_dir"), known & F.col("name").isin(*cache_dirs)).otherwise(removable)
        size = F.when(F.col("is_dir"), 0).otherwise(size)
    return artifacts.filter(at_top(artifacts) & removable).withColumn("freed_bytes", size.cast("bigint"))


def cleanup_summary(plan: DataFrame) -> DataFrame:
    return plan.groupBy("model", "area").agg(
        F.count(F.lit(1)).alias("removed"), (F.sum("freed_bytes") / MB).alias("size_mb")
    )


def quant_name(name: Column) -> Column:
    return F.element_at(F.split(F.replace(name, F.lit(".gguf"), F.lit("")), "-"), -1)


def quant_quality(quant: Column) -> Column:
    label = F
    for fragment, text in QUANT_QUALITY:
        label = label.when(quant.contains(fragment), text)
    return label.otherwise("Unknown")


def quant_table(artifacts: DataFrame) -> DataFrame:
    files = artifacts.filter(at_top(artifacts) & (F.col("area") == "gguf") & F.col("name").endswith(".gguf"))
    quant = files.withColumn("quant", quant_name(F.col("name")))
    return quant.select(
        "model", "name", "quant", (F.col("length") / GB).alias("size_gb"), quant_quality(F.col("quant")).alias("quality")
    )


def quant_range(table: DataFrame) -> DataFrame:
    return table.groupBy("model").agg(F.min("size_gb").alias("min_gb"), F.max("size_gb").alias("max_gb"))


def preferred_quant(table: DataFrame, order: str = "name") -> DataFrame:
    """Per model the recommended quantisation, or the first file in order."""
    best = F.min(F.struct(F.col("quant") != PREFERRED_QUANT, F.col(order), F.col("quant"), F.col("name").alias("file")))
    return table.groupBy("model").agg(best.alias("best")).select("model", "best.quant", "best.file")


def missing_outputs(
    requested: DataFrame, existing: DataFrame, force: bool = False, known: Sequence[str] = OUTPUT_FORMATS
) -> DataFrame:
    """Formats to build from ``requested(model, format)``: those not there yet, or all if forced."""
    todo = requested.select("model", "format").distinct()
    if not force:
        todo = todo.join(existing.select("model", "format").distinct(), ["model", "format"], "left_anti")
    kind = (
        F.when(~F.col("format").isin(*known), "unknown")
        .when(F.col("format").startswith("gguf_"), "gguf")
        .otherwise("other")
    )
    return todo.withColumn("kind", kind)


def legacy_files(artifacts: DataFrame) -> DataFrame:
    return artifacts.filter(F.col("name").startswith("model.") & F.col("name").endswith(".gguf"))
