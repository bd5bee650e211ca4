"""Bands that turn score and loss changes into words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def score_verdict(points: Column) -> Column:
    """Verdict on a score change given in percentage points."""
    return (
        F.when(points >= 10, "excellent")
        .when(points >= 5, "good")
        .when(points >= 2, "marginal")
        .when(points >= 0, "weak")
        .when(points > -3, "acceptable loss")
        .when(points >= -5, "regression")
        .otherwise("possible forgetting")
    )


def direction(delta: Column) -> Column:
    return F.when(delta > 0, "↗").when(delta < 0, "↘").otherwise("→")


def judge(compared: DataFrame) -> DataFrame:
    """Verdict and direction beside each score change, which ``compare`` gives as a fraction."""
    return compared.withColumns({"verdict": score_verdict(F.col("delta") * 100), "direction": direction(F.col("delta"))})


def goal_verdict(general_change: Column, task_change: Column, bearable: float = 15.0, alarming: float = 20.0) -> Column:
    """Weigh a change in general benchmarks (percent) against the change in the own task.

    A drop is fine while it stays bearable and the task gains; both falling is a
    problem; anything else is to be looked into.
    """
    return (
        F.when((general_change < 0) & (task_change < 0), "problem")
        .when(general_change < -alarming, "investigate")
        .when(task_change <= 0, "investigate")
        .when(general_change < -bearable, "watch")
        .otherwise("fine")
    )
