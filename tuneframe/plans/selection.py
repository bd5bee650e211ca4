"""The value at a rank of each group, without sorting a group or putting it into one task."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Binary digits of a value that tell its range. A value of more digits shares its range with 2**(digits - DIGITS).
DIGITS = 10


def value_range(value: Column) -> Column:
    """The range of a whole number from 0: itself below 2**DIGITS, else its leading digits and how many follow."""
    rest = F.greatest(F.lit(0), F.length(F.bin(value)) - DIGITS)
    return F.call_function("shiftright", value.cast("bigint"), rest) + rest.cast("bigint") * (1 << DIGITS)


def _passed(cells: Column, left: Column) -> Column:
    """(at, left): of cells (at, n) in order, the one that holds the left-th element, and which of its own that is."""
    start = F.struct(F.lit(None).cast("bigint").alias("at"), left.alias("left"))
    return F.aggregate(
        cells,
        start,
        lambda found, cell: F.when(found["at"].isNotNull(), found)
        .when(found["left"] < cell["n"], F.struct(cell["at"].alias("at"), found["left"].alias("left")))
        .otherwise(F.struct(F.lit(None).cast("bigint").alias("at"), (found["left"] - cell["n"]).alias("left"))),
    )


def value_at(
    counts: DataFrame, position: Callable[[Column], Column], value: str, n: str = "n", by: Sequence[str] = (), name: str = "value"
) -> DataFrame:
    """The value at a position, from 0, of each group's ascending values.

    ``counts`` has a row for each group and value, a whole number from 0, and ``n``, how often it occurs; it is
    read twice. ``position`` makes the position from the group's total. Counts are added up by
    ranges of values first, which are few thousands however many values there are; then only
    the range that holds the position is looked at value by value. Nulls are left out, and a
    group with nothing at the position has no row.
    """
    known = counts.filter(F.col(value).isNotNull()).select(*by, F.col(value).cast("bigint").alias("__at"), F.col(n).alias("__n"))
    ranged = known.withColumn("__range", value_range(F.col("__at")))
    cell = lambda at: F.struct(F.col(at).alias("at"), F.col("__n").alias("n"))
    sums = ranged.groupBy(*by, "__range").agg(F.sum("__n").alias("__n"))
    coarse = sums.groupBy(*by).agg(F.sum("__n").alias("__total"), F.sort_array(F.collect_list(cell("__range"))).alias("__cells"))
    chosen = coarse.select(*by, _passed(F.col("__cells"), position(F.col("__total")).cast("bigint")).alias("__found"))
    chosen = chosen.select(*[F.col(b).alias(f"__by_{i}") for i, b in enumerate(by)], F.col("__found.at").alias("__in"), F.col("__found.left").alias("__left"))
    match = ranged["__range"] == chosen["__in"]
    for i, b in enumerate(by):
        match = match & ranged[b].eqNullSafe(chosen[f"__by_{i}"])
    inside = ranged.join(chosen, match).groupBy(*by).agg(F.sort_array(F.collect_list(cell("__at"))).alias("__cells"), F.max("__left").alias("__left"))
    return inside.select(*by, _passed(F.col("__cells"), F.col("__left"))["at"].alias(name)).filter(F.col(name).isNotNull())
