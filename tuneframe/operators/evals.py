"""Evaluation scores: normalising, choosing, comparing and tabulating them.

The long table is ``scores(model, variant, run_ts, task, key, metric, value, stderr)``
with ``variant`` ``base`` or ``fine-tuned``. Choices within a group are struct minima
or maxima, which Spark combines before the shuffle, so a model with a large share of
the rows does not gather in one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tuneframe.functions.scalars import fixed_point

BASE, TUNED = "base", "fine-tuned"
SUFFIX = ",none"

# Metrics in order of preference, per use of the score.
METRIC_POLICIES: Mapping[str, tuple[str, ...]] = {
    "compare": ("prompt_level_strict_acc", "inst_level_strict_acc", "accuracy", "exact_match", "acc"),
    "leaderboard": ("prompt_level_strict_acc", "inst_level_strict_acc", "exact_match", "accuracy", "acc"),
    "scores": ("acc", "prompt_level_strict_acc", "exact_match"),
}

# Scores a 1.7B base model is expected to reach.
EXPECTED_SCORES = {
    "ifeval": 0.45,
    "gsm8k": 0.10,
    "hellaswag": 0.37,
    "mmlu": 0.48,
    "truthfulqa_mc1": 0.35,
    "truthfulqa_mc2": 0.50,
}

# Fixed value: the tasks named to whoever asks for a misspelt truthfulness task.
TRUTHFUL_HINT = ("truthfulqa_mc1", "truthfulqa_mc2")

#: Characters of the grams by which task names are found.
GRAM = 3

_SCORE_KEY = ("model", "variant", "run_ts", "task")


def normalise_metrics(raw: DataFrame, tasks: Sequence[str] | None = None) -> DataFrame:
    """``raw(model, variant, run_ts, task, key, value)``, numeric values, to metric rows.

    One row per key. ``,none`` leaves the metric's name; the names of other filters stay. A
    standard error is attached to the key it belongs to, in either order of suffixes
    (``acc_stderr,none`` and ``acc,none_stderr``), for every filter; one without a score
    under its key is left out. Keys meet in one aggregation, no self join.
    """
    rows = raw if tasks is None else raw.filter(F.col("task").isin(*tasks))
    key = F.regexp_replace("key", "_stderr(?=,|$)", "")
    return (
        rows.withColumns({"__error": F.col("key").rlike("_stderr(,|$)"), "key": key})
        .groupBy(*_SCORE_KEY, "key")
        .agg(
            F.max(F.when(~F.col("__error"), F.col("value"))).alias("value"),
            F.bool_or(~F.col("__error")).alias("__scored"),
            F.max(F.when(F.col("__error"), F.col("value"))).alias("stderr"),
        )
        .filter("__scored")
        .select(*_SCORE_KEY, "key", F.replace("key", F.lit(SUFFIX), F.lit("")).alias("metric"), "value", "stderr")
    )


def _rank(metric: Column, policy: Sequence[str]) -> Column:
    chosen = F
    for place, name in enumerate(policy):
        chosen = chosen.when(metric == name, place)
    return chosen.otherwise(F.lit(None).cast("int"))


def primary_metric(scores: DataFrame, policy: str = "compare") -> DataFrame:
    """The preferred metric of every task in a run.

    ``leaderboard`` takes names with or without the suffix, bare ones first, and falls back
    to the first other metric by name; the other policies want the suffix and else give no row.
    """
    names = METRIC_POLICIES[policy]
    rank = _rank(F.col("metric"), names)
    suffixed = F.col("key").endswith(SUFFIX)
    if policy == "leaderboard":
        place = rank * 2 + suffixed.cast("int")
    else:
        place = F.when(F.col("key") == F.concat(F.col("metric"), F.lit(SUFFIX)), rank * 2)
    placed = scores.withColumn("__place", place)
    metric = F.get(F.array(*[F.lit(name) for name in names]), F.floor(F.col("__place") / 2).cast("int"))
    # A number tells the metric and its suffix, so numbers are compared and no rows are sorted.
    best = [F.min("__place").alias("__place"), F.min_by("value", "__place").alias("value")]
    if policy != "leaderboard":
        chosen = placed.filter(F.col("__place").isNotNull()).groupBy(*_SCORE_KEY).agg(*best)
        return chosen.select(*_SCORE_KEY, metric.alias("metric"), "value")
    # The few other metrics of a task are gathered, for tasks that have none of the preferred.
    other = F.when(F.col("__place").isNull(), F.struct("metric", suffixed.alias("suffixed"), "value"))
    chosen = placed.groupBy(*_SCORE_KEY).agg(*best, F.array_min(F.collect_list(other)).alias("__other"))
    found = F.col("__place").isNotNull()
    return chosen.select(
        *_SCORE_KEY,
        F.when(found, metric).otherwise(F.col("__other.metric")).alias("metric"),
        F.when(found, F.col("value")).otherwise(F.col("__other.value")).alias("value"),
    )


def latest_runs(runs: DataFrame, scores: DataFrame | None = None) -> DataFrame:
    """The newest fine-tuned run of each model, by its timestamp name.

    ``runs(model, variant, run_ts)`` lists the run directories. A newest run without
    scores hides older ones, as a directory listing would; pass ``scores`` to look
    only at runs that have some. Runs are made distinct by hashing before their names are compared.
    """
    listed = scores if scores is not None else runs
    names = listed.filter(F.col("variant") == TUNED).select("model", "run_ts").distinct()
    newest = Window.partitionBy("model").orderBy(F.col("run_ts").desc_nulls_last())
    return names.withColumn("__n", F.row_number().over(newest)).filter("__n = 1").drop("__n")


def latest_scores(scores: DataFrame, runs: DataFrame | None = None) -> DataFrame:
    """All base scores, and of each model the fine-tuned scores of its newest run."""
    newest = latest_runs(runs if runs is not None else scores)
    return keep_latest(scores, newest)


def keep_latest(rows: DataFrame, newest: DataFrame) -> DataFrame:
    """Base rows, and fine-tuned rows of the run named in ``newest(model, run_ts)``."""
    named = newest.select("model", F.col("run_ts").alias("__newest"))
    joined = rows.join(named, "model", "left")
    is_base = F.col("variant") == BASE
    return joined.filter(is_base | (F.col("run_ts") == F.col("__newest"))).select(*rows.columns)


def _task_sides(scores: DataFrame) -> DataFrame:
    """One row per model and task: which sides have it, and the preferred shared metric."""
    side = lambda variant: F.max(F.when(F.col("variant") == variant, F.col("value")))
    seen = lambda variant: F.bool_or(F.col("variant") == variant)
    per_key = scores.groupBy("model", "task", "key", "metric").agg(
        side(BASE).alias("base"), side(TUNED).alias("tuned"), seen(BASE).alias("in_base"), seen(TUNED).alias("in_tuned")
    )
    rank = F.when(
        (F.col("key") == F.concat(F.col("metric"), F.lit(SUFFIX)))
        & F.col("base").isNotNull()
        & F.col("tuned").isNotNull(),
        _rank(F.col("metric"), METRIC_POLICIES["compare"]),
    )
    per_task = (
        per_key.withColumn("__rank", rank)
        .groupBy("model", "task")
        .agg(
            F.min("__rank").alias("best"),
            F.min_by("base", "__rank").alias("base"),
            F.min_by("tuned", "__rank").alias("tuned"),
            F.bool_or("in_base").alias("in_base"),
            F.bool_or("in_tuned").alias("in_tuned"),
        )
    )
    found = F.col("best").isNotNull()
    base, tuned = (F.when(found, F.col(c)).otherwise(0.0) for c in ("base", "tuned"))
    names = F.array(*[F.lit(name) for name in METRIC_POLICIES["compare"]])
    return per_task.select(
        "model",
        "task",
        "in_base",
        "in_tuned",
        F.get(names, F.col("best")).alias("metric"),
        base.alias("base_accuracy"),
        tuned.alias("finetuned_accuracy"),
        (tuned - base).alias("delta"),
        F.when(base > 0, (tuned - base) / base * 100).otherwise(F.lit(0.0)).alias("delta_percent"),
    )


def compare(scores: DataFrame) -> DataFrame:
    """Base against fine-tuned on every task that both have.

    The first metric of the ``compare`` policy found on both sides is used; without
    one the metric is null and the numbers are zero. Input has at most one base and
    one fine-tuned run per model.
    """
    return _task_sides(scores).filter("in_base AND in_tuned").drop("in_base", "in_tuned")


def summary(scores: DataFrame) -> DataFrame:
    """One row per model: which sides exist, and the comparison where both do.

    The map has one entry per task, so its size is bound by the task list.
    """
    entry = F.struct("metric", "base_accuracy", "finetuned_accuracy", "delta", "delta_percent")
    shared = F.when(F.col("in_base") & F.col("in_tuned"), F.struct("task", entry))
    return (
        _task_sides(scores)
        .groupBy("model")
        .agg(
            F.bool_or("in_base").alias("has_base"),
            F.bool_or("in_tuned").alias("has_tuned"),
            F.map_from_entries(F.sort_array(F.collect_list(shared))).alias("comparison"),
        )
        .withColumn("comparison", F.when(F.size("comparison") > 0, F.col("comparison")))
    )


def leaderboard_rows(scores: DataFrame) -> DataFrame:
    """(model, variant, task, shown): primary scores with four decimals; models without tuned scores are left out.

    ``scores`` has at most one run per model and variant. One row per score, for any number of tasks.
    """
    best = primary_metric(scores, "leaderboard").withColumn("shown", fixed_point(F.col("value"), 4))
    tuned = best.filter(F.col("variant") == TUNED).select("model").distinct()
    return best.join(tuned, "model", "left_semi").select("model", "variant", "task", "shown")


def leaderboard(scores: DataFrame, tasks: Sequence[str]) -> DataFrame:
    """``leaderboard_rows`` with the named tasks as columns, a dash where a task has no score.

    Both variants of a model are brought into one row of numbers, which tells whether it has
    tuned scores without a join, and are parted and shown as text afterwards.
    """
    names = sorted(tasks)
    sides = (BASE, TUNED)
    value = lambda side, task: F.max(F.when((F.col("variant") == side) & (F.col("task") == task), F.col("value")))
    cells = [value(side, task).alias(f"__{i}_{j}") for i, side in enumerate(sides) for j, task in enumerate(names)]
    there = [F.bool_or(F.col("variant") == side).alias(f"__has_{i}") for i, side in enumerate(sides)]
    table = primary_metric(scores, "leaderboard").groupBy("model").agg(*there, *cells).filter("__has_1")
    rows = [F.struct(F.lit(side).alias("variant"), F.col(f"__has_{i}").alias("has"), *[F.col(f"__{i}_{j}").alias(f"c{j}") for j in range(len(names))]) for i, side in enumerate(sides)]
    parted = table.select("model", F.inline(F.array(*rows))).filter("has")
    shown = [F.when(F.col(f"c{j}").isNotNull(), fixed_point(F.col(f"c{j}"), 4)).otherwise("-").alias(name) for j, name in enumerate(names)]
    return parted.select("model", "variant", *shown)


def expected_scores(spark: SparkSession, scores: Mapping[str, float] = EXPECTED_SCORES) -> DataFrame:
    return spark.createDataFrame(list(scores.items()), "task string, expected double")


def baseline_gap(best: DataFrame, expected: DataFrame) -> DataFrame:
    """Primary scores against ``expected(task, expected)``, one row per task."""
    joined = best.join(expected, "task", "left")
    return joined.withColumn("gap", F.col("value") - F.col("expected"))


def invalid_tasks(requested: DataFrame, valid: DataFrame) -> DataFrame:
    """Requested names that are no valid task; both tables have a column ``task``."""
    return requested.select("task").distinct().join(valid.select("task").distinct(), "task", "left_anti")


def _grams(text: Column, size: int) -> Column:
    """All runs of ``size`` characters of a text, none if it is shorter."""
    starts = F.when(F.length(text) >= size, F.sequence(F.lit(1), F.length(text) - size + 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: text.substr(i, F.lit(size)))


def suggest_tasks(invalid: DataFrame, valid: DataFrame, n: int = 3) -> DataFrame:
    """Up to ``n`` valid names, in order, that contain the invalid one in any case.

    An index of the names' grams, ``GRAM`` characters or fewer, is linear in their length. Of
    the grams of a wanted part the one that the fewest names have finds the candidates, and
    containment is checked for those. Parts asked for keep their first ``n`` names.
    Truthfulness tasks get a fixed hint instead.
    """
    wanted = invalid.select("task", F.lower("task").alias("__part")).distinct()
    hint = F.lower("task").contains("truthful")
    names = valid.select(F.col("task").alias("suggestion")).distinct().withColumn("__low", F.lower("suggestion"))
    sizes = F.array(*[F.array_distinct(_grams(F.col("__low"), size)) for size in range(1, GRAM + 1)])
    index = names.select("suggestion", "__low", F.explode(F.flatten(sizes)).alias("__gram"))
    asked = wanted.filter(~hint)
    whole = F.when(F.length("__part") < GRAM, F.array("__part")).otherwise(F.array_distinct(_grams(F.col("__part"), GRAM)))
    parts = asked.select("__part").distinct().select("__part", F.explode(whole).alias("__gram"))
    held = index.join(parts.select("__gram").distinct(), "__gram", "left_semi").groupBy("__gram").agg(F.count(F.lit(1)).alias("__names"))
    rarest = parts.join(held, "__gram").groupBy("__part").agg(F.min_by("__gram", F.struct("__names", "__gram")).alias("__gram"))
    matching = rarest.join(index, "__gram").filter(F.col("__low").contains(F.col("__part")))
    first = Window.partitionBy("__part").orderBy("suggestion")
    # A row number under a limit is cut down per task before the shuffle.
    ranked = matching.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= n)
    similar = asked.join(ranked, "__part").select("task", "suggestion", "rank")
    fixed = wanted.filter(hint).select(
        "task", F.posexplode(F.array(*[F.lit(t) for t in TRUTHFUL_HINT])).alias("rank", "suggestion")
    )
    return similar.unionByName(fixed.select("task", "suggestion", (F.col("rank") + 1).alias("rank")))


def limit_per_task(samples: DataFrame, task: str = "task", order_key: str = "id", n: int = 5) -> DataFrame:
    """The first ``n`` samples of each task; a hot task is cut down before the shuffle."""
    frame = Window.partitionBy(task).orderBy(order_key)
    return samples.withColumn("rank", F.row_number().over(frame)).filter(F.col("rank") <= n)
