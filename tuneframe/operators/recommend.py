"""Training settings recommended from dataset size, lengths and memory.

Every function is a column expression over per-dataset columns; ``recommend`` puts
them together for a table with one row per dataset.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Curated datasets that count as high quality by name.
CURATED_NAMES = ("GAIR/lima", "databricks/databricks-dolly-15k")

LONG_ANSWER_TOKENS = 800
EFFECTIVE_BATCH = 8
MAX_SAFE_EPOCHS = 3
SECONDS_PER_STEP = (2, 4)

# Sizes below a bound get rank, alpha and learning rate of its row.
LORA_TIERS = ((5_000, 64, 128, 3e-4), (20_000, 32, 64, 2e-4), (None, 16, 32, 2e-4))


def quality_tier(name: Column, avg_length: Column, curated: Sequence[str] = CURATED_NAMES) -> Column:
    known = F.lit(False)
    for part in curated:
        known = known | name.contains(part)
    high = known | F.coalesce(avg_length > LONG_ANSWER_TOKENS, F.lit(False))
    return F.when(high, "high").otherwise("standard")


def target_epochs(tier: Column) -> Column:
    return F.when(tier == "high", 3).otherwise(1)


def lora_tier(n: Column) -> Column:
    chosen = F
    for bound, rank, alpha, rate in LORA_TIERS:
        tier = F.struct(F.lit(rank).alias("rank"), F.lit(alpha).alias("alpha"), F.lit(rate).alias("learning_rate"))
        if bound is None:
            return chosen.otherwise(tier)
        chosen = chosen.when(n < bound, tier)
    raise AssertionError("the last tier has no bound")


def batch_tier(vram_gb: Column) -> Column:
    """Two by four on a GPU with under 8 GB free, else four by two; null means no GPU."""
    small = F.coalesce(vram_gb < 8, F.lit(False))
    return F.struct(
        F.when(small, 2).otherwise(4).alias("size"),
        F.when(small, 4).otherwise(2).alias("accumulation"),
    )


def training_plan(n: Column, epochs: Column) -> Column:
    per_epoch = F.ceil(n / EFFECTIVE_BATCH)
    steps = per_epoch * epochs
    low, high = SECONDS_PER_STEP
    return F.struct(
        per_epoch.alias("steps_per_epoch"),
        steps.alias("total_steps"),
        (steps * EFFECTIVE_BATCH).alias("samples_seen"),
        (steps * low / 60).alias("minutes_low"),
        (steps * high / 60).alias("minutes_high"),
    )


def current_plan(n: Column, max_steps: Column, batch: Column, accumulation: Column, epochs: Column) -> Column:
    """Steps, samples and epochs of the settings as they are; steps win over epochs."""
    effective = batch * accumulation
    by_steps = max_steps > 0
    steps = F.when(by_steps, max_steps).otherwise(F.ceil(F.try_divide(n.cast("double"), effective)) * epochs)
    return F.struct(
        steps.cast("bigint").alias("total_steps"),
        F.when(by_steps, max_steps * effective).cast("bigint").alias("samples_seen"),
        F.when(by_steps, F.try_divide((max_steps * effective).cast("double"), n)).otherwise(epochs).alias("epochs"),
    )


def overfit_steps(n: Column, max_steps: Column, effective: Column, epochs: Column) -> Column:
    """The steps to use instead, where the steps set run over more than three epochs; else null.

    ``epochs`` are those of the dataset's tier (``target_epochs``), not the ones set now.
    """
    implied = F.try_divide((max_steps * effective).cast("double"), n)
    return F.when((max_steps > 0) & (implied > MAX_SAFE_EPOCHS), F.ceil(n / EFFECTIVE_BATCH) * epochs)


def vram_estimate(rank: Column) -> Column:
    return F.lit(6.0) + rank / 16 * 2


def vram_fallbacks(rank: Column, alpha: Column, vram_gb: Column) -> Column:
    """Settings to try in turn where the free memory is below the estimate; else an empty array."""
    def option(name: str, batch: int | None, accumulation: int | None, r: Column, a: Column) -> Column:
        return F.struct(
            F.lit(name).alias("option"),
            F.lit(batch).cast("int").alias("batch_size"),
            F.lit(accumulation).cast("int").alias("accumulation"),
            r.cast("int").alias("rank"),
            a.cast("int").alias("alpha"),
        )

    none = F.lit(None)
    half_rank, half_alpha = F.floor(rank / 2), F.floor(alpha / 2)
    options = F.array(
        option("smaller batch", 2, 4, none, none),
        option("lower rank", None, None, half_rank, half_alpha),
        option("lower alpha", None, None, none, rank),
        option("both", 2, None, half_rank, none),
    )
    tight = F.coalesce(vram_gb < vram_estimate(rank), F.lit(False))
    return F.filter(options, lambda o: tight)


def gpu_advice(vram_gb: Column) -> Column:
    return (
        F.when(vram_gb.isNull(), "no gpu")
        .when(vram_gb < 4, "batch of one, gradient checkpointing on")
        .when(vram_gb < 8, "balanced, gradient checkpointing optional")
        .otherwise("larger batch, gradient checkpointing off")
    )


def training_scope(
    samples: Column, max_steps: Column, batch: Column, accumulation: Column, max_samples: Column, epochs: Column
) -> Column:
    """How much of the dataset a run used, as text."""
    used = (
        F.when(max_steps > 0, max_steps * batch * accumulation)
        .when(max_samples > 0, max_samples * epochs)
        .otherwise(samples)
    )
    tail = F.concat(F.lit(" ("), epochs.cast("string"), F.lit(" epoch(s)"))
    return (
        F.when(samples.isNull() | used.isNull(), F.concat(epochs.cast("string"), F.lit(" epoch(s)")))
        .when(
            used < samples,
            F.concat(F.format_number(used, 0), F.lit("/"), F.format_number(samples, 0), F.lit(" samples"), tail, F.lit(")")),
        )
        .otherwise(F.concat(F.format_number(samples, 0), F.lit(" samples"), tail, F.lit(", full dataset)")))
    )


def estimated_scope(max_steps: Column, batch: Column, accumulation: Column, max_samples: Column, epochs: Column) -> Column:
    """What settings lead to before a run, where the size of the dataset is not known yet, as text."""
    by_steps, limited = max_steps > 0, max_samples > 0
    used = F.when(by_steps, max_steps * batch * accumulation).when(limited, max_samples * epochs)
    bound = F.when(limited, F.concat(F.lit("limited to "), F.format_number(max_samples, 0), F.lit(" samples"))).otherwise(
        F.concat(max_steps.cast("string"), F.lit(" steps"))
    )
    rounds = F.concat(epochs.cast("string"), F.lit(" epoch(s)"))
    about = F.concat(F.lit("~"), F.format_number(used, 0), F.lit(" samples ("), rounds, F.lit(", "), bound, F.lit(")"))
    return F.when(used.isNull(), F.concat(rounds, F.lit(", full dataset"))).otherwise(about)


def recommend(datasets: DataFrame) -> DataFrame:
    """Add the recommendation to ``datasets(name, n, avg_length, vram_gb)``; narrow, no shuffle."""
    return (
        datasets.withColumn("quality", quality_tier(F.col("name"), F.col("avg_length")))
        .withColumn("epochs", target_epochs(F.col("quality")))
        .withColumn("lora", lora_tier(F.col("n")))
        .withColumn("batch", batch_tier(F.col("vram_gb")))
        .withColumn("plan", training_plan(F.col("n"), F.col("epochs")))
        .withColumn("vram_needed", vram_estimate(F.col("lora.rank")))
        .withColumn("fallbacks", vram_fallbacks(F.col("lora.rank"), F.col("lora.alpha"), F.col("vram_gb")))
        .withColumn("advice", gpu_advice(F.col("vram_gb")))
    )
