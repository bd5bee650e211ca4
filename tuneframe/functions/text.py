"""Length, token and marker expressions over text columns."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# Phrases that mark step-by-step reasoning in a sample.
REASONING_MARKERS = (
    "<think>",
    "</think>",
    "let me think",
    "let's think",
    "thinking step by step",
    "step 1:",
    "step 2:",
    "step 3:",
    "reasoning:",
    "analysis:",
    "let's break this down",
    "first,",
    "second,",
    "finally,",
)

# Phrases that mark a reasoning chat template.
TEMPLATE_MARKERS = ("<think>", "reasoning", "chain-of-thought", "cot")

# Words that make a training error a sequence-length error.
LENGTH_ERROR_WORDS = ("length", "token", "sequence", "size", "exceed", "overflow")

# A token is a run of ASCII letters and digits, or any other single character
# that is not blank. Explicit classes keep every regex engine in agreement.
TOKEN_PATTERN = r"[A-Za-z0-9]+|[^A-Za-z0-9 \t\r\n]"

SAFE, BORDERLINE, TOO_LONG = "safe", "borderline", "too_long"


@dataclass(frozen=True)
class LengthLimits:
    """The sequence limit and the two thresholds around it."""

    max_seq_length: int

    @property
    def lower(self) -> int:
        return int(self.max_seq_length * 0.8)

    @property
    def upper(self) -> int:
        return int(self.max_seq_length * 1.2)


def estimate_from_chars(chars: Column) -> Column:
    """Four characters per token, rounded down; nothing counts as zero."""
    return F.shiftright(F.coalesce(chars, F.lit(0)), 2)


def estimate_tokens(text: Column) -> Column:
    return estimate_from_chars(F.length(text))


def count_tokens(text: Column, pattern: str = TOKEN_PATTERN) -> Column:
    """Number of tokens, computed inside the JVM.

    For the default pattern each word shrinks to its first character and blanks
    vanish in one pass, so the string length is the count and no token array is built.
    """
    if pattern == TOKEN_PATTERN:
        shrunk = F.regexp_replace(text, r"([A-Za-z0-9])[A-Za-z0-9]*+[ \t\r\n]*+|[ \t\r\n]++", "$1")
        return F.coalesce(F.length(shrunk), F.lit(0))
    return F.coalesce(F.regexp_count(text, F.lit(pattern)), F.lit(0))


def token_count(text: str, pattern: str = TOKEN_PATTERN) -> int:
    """The same for a constant, on the driver."""
    return len(re.findall(pattern, text))


def token_array(text: Column, pattern: str = TOKEN_PATTERN) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def length_zone(estimated: Column, limits: LengthLimits) -> Column:
    """Only the borderline zone, both ends included, needs an exact count."""
    return (
        F.when(estimated < limits.lower, SAFE)
        .when(estimated > limits.upper, TOO_LONG)
        .otherwise(BORDERLINE)
    )


def contains_any(text: Column, needles: Sequence[str]) -> Column:
    """True if the lower-cased text holds one of the needles; null text holds none."""
    lowered = F.lower(text)
    found = F.lit(False)
    for needle in needles:
        found = found | lowered.contains(needle)
    return F.coalesce(found, F.lit(False))


def has_reasoning(text: Column, markers: Sequence[str] = REASONING_MARKERS) -> Column:
    return contains_any(text, markers)


def template_is_reasoning(template: Column) -> Column:
    return contains_any(template, TEMPLATE_MARKERS)


def is_length_error(message: Column) -> Column:
    return contains_any(message, LENGTH_ERROR_WORDS)
