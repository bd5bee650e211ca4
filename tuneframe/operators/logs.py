"""Cleaning and triage of evaluation logs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Harmless lines that are left out of the shown log.
NOISE = ("Unable to detect language", "No features in text")

# The first class with a phrase in the end of the log names the failure.
FAILURE_CLASSES = (
    ("langdetect", ("langdetect",)),
    ("missing_module", ("No module named",)),
    ("out_of_memory", ("CUDA out of memory", "OutOfMemoryError")),
    ("missing_file", ("No such file or directory", "FileNotFoundError")),
    ("no_chat_template", ("tokenizer.chat_template is not set",)),
)
TAIL_CHARS = 2000


def filter_log_lines(lines: DataFrame, line: str = "line", noise: Sequence[str] = NOISE) -> DataFrame:
    noisy = F.lit(False)
    for phrase in noise:
        noisy = noisy | F.col(line).contains(phrase)
    return lines.filter(~F.coalesce(noisy, F.lit(False)))


def log_tail(log: Column, chars: int = TAIL_CHARS) -> Column:
    """The end of the log is all that is looked at, by definition of the triage."""
    return F.right(log, F.lit(chars))


def triage_failures(logs: DataFrame, log: str = "log") -> DataFrame:
    """Add ``failure`` and, for a missing module, ``module``."""
    tail = log_tail(F.col(log))
    failure = F
    for name, phrases in FAILURE_CLASSES:
        hit = tail.contains(phrases[0])
        for phrase in phrases[1:]:
            hit = hit | tail.contains(phrase)
        failure = failure.when(hit, name)
    quoted = F.regexp_extract(tail, "No module named '([^']*)", 1)
    named = F.when(tail.contains("No module named '"), quoted).otherwise("unknown")
    return logs.withColumn("failure", failure.otherwise("other")).withColumn(
        "module", F.when(F.col("failure") == "missing_module", named)
    )
