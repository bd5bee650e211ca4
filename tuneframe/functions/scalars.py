"""Parsing and formatting of single values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spellings of true; every other spelling is false.
TRUE_WORDS = ("true", "1", "yes", "on")

# Fixed value: a number with an optional unit of seconds or minutes.
DURATION_PATTERN = r"^([0-9]+)[ \t\r\n]*(min|m|sec|s)?$"


def parse_bool(text: Column) -> Column:
    return F.coalesce(F.lower(text).isin(*TRUE_WORDS), F.lit(False))


def parse_duration(text: Column) -> Column:
    """Seconds; a bare number is seconds, and text of another form is null."""
    cleaned = F.lower(F.btrim(text, F.lit(" \t\r\n")))
    number = F.regexp_extract(cleaned, DURATION_PATTERN, 1).try_cast("bigint")
    unit = F.regexp_extract(cleaned, DURATION_PATTERN, 2)
    return F.when(unit.startswith("m"), number * 60).otherwise(number)


def is_duration(text: Column) -> Column:
    """Whether ``parse_duration`` has a result; texts too short to exceed 64 bits need no parsing for that."""
    form = DURATION_PATTERN.replace("^", r"(?i)^[ \t\r\n]*").replace("$", r"[ \t\r\n]*$")
    return F.when(F.length(text) <= 18, text.rlike(form)).otherwise(parse_duration(text).isNotNull())


def fixed_point(value: Column, digits: int) -> Column:
    """Text with ``digits`` decimals, rounded as C and Python do.

    They round the exact binary value, ties to the even digit; Java rounds the shortest
    decimal form, ties up. The two part only where that form is a tie, so a value that
    has to go down is moved down by a hair first. Its distance to the tie is exact:
    split into a float and the rest, both products fit a double.
    """
    number = value.cast("double")
    size = F.abs(number)
    scale = 2.0 * 10**digits
    high = size.cast("float").cast("double")
    below = F.floor(size * 10.0**digits)
    past_tie = (high * scale - (below * 2 + 1)) + (size - high) * scale
    # At the tie itself only an even digit below keeps the value down.
    goes_down = past_tie < F.when(below % 2 == 0, F.lit(5e-324)).otherwise(F.lit(0.0))
    return F.format_string(f"%.{digits}f", number * F.when(goes_down, 1.0 - 2.0**-52).otherwise(1.0))


def human_size(size: Column) -> Column:
    """Bytes in the largest fitting unit up to TB, with two decimals."""
    scaled = size.cast("double")
    label = F
    for power, unit in enumerate(("B", "KB", "MB", "GB")):
        text = F.concat(fixed_point(scaled / 1024.0**power, 2), F.lit(f" {unit}"))
        label = label.when(scaled < 1024.0 ** (power + 1), text)
    return label.otherwise(F.concat(fixed_point(scaled / 1024.0**4, 2), F.lit(" TB")))


def signed_percent(value: Column) -> Column:
    """One decimal and a percent sign; a plus sign only for gains."""
    return F.concat(F.when(value > 0, "+").otherwise(""), fixed_point(value, 1), F.lit("%"))
