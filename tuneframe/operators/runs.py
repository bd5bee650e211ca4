"""Loss histories, run metrics and the registry of backups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tuneframe.functions.names import backup_name, backup_parts
from tuneframe.plans.ordered import running
from tuneframe.sources.runs import LOSS_COLUMNS


def loss_rows(log: DataFrame, run: str = "run") -> DataFrame:
    """Log entries that carry a loss."""
    return log.filter(F.col("loss").isNotNull()).select(run, *LOSS_COLUMNS)


def last_loss(log: DataFrame, run: str = "run") -> DataFrame:
    """The loss row with the highest step of each run, combined before the shuffle.

    Steps are unique in a run. One number per column keeps the aggregation hashed; a
    struct would have the rows sorted.
    """
    others = [F.max_by(name, "step").alias(name) for name in LOSS_COLUMNS[1:]]
    return loss_rows(log, run).groupBy(run).agg(F.max("step").alias("step"), *others)


def append_final_step(log: DataFrame, runs: DataFrame, run: str = "run") -> DataFrame:
    """Repeat the last loss row at ``total_steps`` where logging stopped before it.

    Both sides of the join hold one row per run, so a long run adds no skew.
    """
    totals = runs.select(run, "total_steps")
    missing = last_loss(log, run).join(totals, run).filter(F.col("step") < F.col("total_steps"))
    final = missing.select(
        run, F.col("total_steps").cast(log.schema["step"].dataType).alias("step"), *LOSS_COLUMNS[1:]
    )
    return loss_rows(log, run).unionByName(final)


def final_loss(log: DataFrame, runs: DataFrame, run: str = "run") -> DataFrame:
    """Last loss of the history, or the mean training loss of runs without one."""
    last = last_loss(log, run).select(run, F.col("loss").alias("last_loss"))
    return runs.join(last, run, "left").select(
        run, F.coalesce(F.col("last_loss"), F.col("train_loss")).alias("final_loss")
    )


def run_metrics(runs: DataFrame) -> DataFrame:
    """Add the derived columns of the run registry."""
    warmup = F.when(F.col("warmup_steps") > 0, F.col("warmup_steps").cast("bigint")).otherwise(
        F.floor(F.col("total_steps") * F.col("warmup_ratio"))
    )
    return runs.withColumns(
        {
            "training_time_minutes": F.col("training_time_seconds") / 60,
            "effective_batch_size": F.col("batch_size") * F.col("gradient_accumulation_steps"),
            "actual_warmup_steps": warmup,
            "max_vram_gb": F.when(F.col("max_vram_bytes") != 0, F.col("max_vram_bytes") / 1024.0**3),
        }
    )


def add_backup_name(runs: DataFrame) -> DataFrame:
    date = F.coalesce(F.col("trained_date"), F.col("timestamp"))
    return runs.withColumn(
        "backup_name", backup_name(date, F.col("lora_rank"), F.col("learning_rate"), F.col("final_loss"))
    )


def parse_backup_names(df: DataFrame, name: str = "backup_name") -> DataFrame:
    return df.withColumn("parts", backup_parts(F.col(name))).select("*", "parts.*").drop("parts")


def list_backups(
    files: DataFrame, metrics: DataFrame | None = None, marker: str = "adapter_config.json", newest: bool = False
) -> DataFrame:
    """Backups from ``files(model, backup, name, length)``: those that hold the marker file.

    ``metrics(model, backup, ...)`` has at most one row per backup and may lack some.
    With ``newest`` they are in order, for each model the newest name first: names are
    sorted before anything is parsed, as Spark looks at the rows of a sort twice.
    """
    found = (
        files.groupBy("model", "backup")
        .agg(F.sum("length").alias("size"), F.bool_or(F.col("name") == marker).alias("__marked"))
        .filter("__marked")
        .drop("__marked")
    )
    listed = found.join(metrics, ["model", "backup"], "left") if metrics is not None else found
    return parse_backup_names(newest_first(listed) if newest else listed, "backup")


def newest_first(backups: DataFrame) -> DataFrame:
    return backups.orderBy("model", F.col("backup").desc())


def latest_run(runs: DataFrame, root: str, modified: str, run: str) -> DataFrame:
    """The most recently changed run under each root; names break ties."""
    newest = F.max(F.struct(F.col(modified), F.col(run)))
    return runs.groupBy(root).agg(newest.alias("newest")).select(root, "newest.*")


def loss_health(
    log: DataFrame,
    run: str = "run",
    order: str = "step",
    window: int = 5,
    spike: float = 2.0,
    plateau: float = 0.01,
    slices: int | None = None,
) -> DataFrame:
    """Label each loss row ``start``, ``spike``, ``rising``, ``plateau`` or ``falling``.

    The row is held against the mean of up to ``window`` rows before it: above
    ``spike`` times that mean is a spike, within ``plateau`` of it a plateau. Rows are
    sorted once; a slice of a long run gets the last ``window`` losses before it, and their minimum.
    """
    rows = running(
        loss_rows(log, run), {"best_loss": ("min", F.col("loss"))}, [order], [run], {"recent": (window, F.col("loss"))}, slices
    )
    mean = F.aggregate("recent", F.lit(0.0), lambda a, x: a + x) / F.nullif(F.size("recent"), F.lit(0))
    judged = rows.withColumns({"previous_loss": F.try_element_at("recent", F.lit(-1)), "recent_mean": mean})
    change = F.col("loss") - F.col("recent_mean")
    health = (
        F.when(F.col("recent_mean").isNull(), "start")
        .when(F.col("loss") > F.col("recent_mean") * spike, "spike")
        .when(F.abs(change) <= F.abs(F.col("recent_mean")) * plateau, "plateau")
        .when(change > 0, "rising")
        .otherwise("falling")
    )
    return judged.withColumn("health", health).drop("recent")


def compare_runs(runs: DataFrame, comparison: DataFrame, task: str | None = None) -> DataFrame:
    """Experiment table: settings of each run beside the score change of its model.

    ``comparison`` has one row per model and task.
    """
    scores = comparison if task is None else comparison.filter(F.col("task") == task)
    settings = runs.select("model", "dataset_name", "learning_rate", "lora_rank")
    return scores.select("model", "task", "metric", "delta", "delta_percent").join(settings, "model")
