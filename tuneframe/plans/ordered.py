"""Ordered computations that never put one key, or the whole table, into one task.

Spark evaluates a window by gathering each partition key in one task. Here rows are
range-partitioned by key and order, so that a hot key is spread over many slices; every
slice is computed by itself and then shifted by a carry from the slices before it. A range cut can split one key per slice at
most, so there are never more carries than slices.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tuneframe.session import settle

_SLICE = "__slice"
_AGGREGATE = {"sum": F.sum, "min": F.min, "max": F.max, "count": F.count}
_MERGE = {
    "sum": lambda a, b: a + b,
    "count": lambda a, b: a + b,
    "min": F.least,
    "max": F.greatest,
}


def running(
    df: DataFrame,
    totals: Mapping[str, tuple[str, Column]],
    order: Sequence[str],
    keys: Sequence[str] = (),
    tails: Mapping[str, tuple[int, Column]] | None = None,
    slices: int | None = None,
) -> DataFrame:
    """Add running aggregates ``{column: (sum|count|min|max, value)}`` up to each row.

    ``tails``, ``{column: (size, value)}``, adds arrays of up to so many values before the row, the last one
    at the end. ``order`` has to be unique within a key. ``slices`` fixes how many there are.
    """
    ranged = df.repartitionByRange(*([slices] if slices else []), *keys, *order)
    sliced = settle(ranged.withColumn(_SLICE, F.spark_partition_id()))
    rows = Window.partitionBy(_SLICE, *keys).orderBy(*order)
    frame = rows.rowsBetween(Window.unboundedPreceding, 0)
    local = sliced.withColumns(
        {name: _AGGREGATE[kind](value).over(frame) for name, (kind, value) in totals.items()}
        | {name: F.collect_list(F.struct(value.alias("v"))).over(rows.rowsBetween(-size, -1)) for name, (size, value) in (tails or {}).items()}
    )
    if totals:
        local = _merge(local, _carries(sliced, totals, keys), {name: kind for name, (kind, _) in totals.items()}, keys)
    if tails:
        local = _with_tails(local, _tails(sliced, tails, order, keys), tails, keys)
    return local.drop(_SLICE)


def _tails(sliced: DataFrame, tails: Mapping[str, tuple[int, Column]], order: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """The last values before each slice of the key that begins it: a bounded array for a slice.

    Only the last key of a slice can go on in the next, so the last rows of slices are
    enough, and a row number under a limit is cut down per task.
    """
    most = max(size for size, _ in tails.values())
    back = Window.partitionBy(_SLICE).orderBy(*[F.col(c).desc() for c in (*keys, *order)])
    ends = sliced.withColumn("__back", F.row_number().over(back)).filter(F.col("__back") <= most)
    kept = lambda value: F.transform(F.sort_array(F.collect_list(F.struct(*order, value.alias("v")))), lambda x: F.struct(x["v"].alias("v")))
    held = ends.groupBy(_SLICE, *keys).agg(*[kept(value).alias(f"__{name}") for name, (_, value) in tails.items()])
    first = sliced.groupBy(_SLICE).agg(F.min(F.struct(F.lit(0), *keys)).alias("__first")).select(_SLICE, *[F.col("__first")[k].alias(k) for k in keys])
    both = held.unionByName(first, allowMissingColumns=True).groupBy(_SLICE, *keys)
    merged = both.agg(*[F.first(f"__{name}", ignorenulls=True).alias(f"__{name}") for name in tails])
    before = Window.partitionBy(*keys).orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    carried = {f"__{name}": _last(F.flatten(F.collect_list(f"__{name}").over(before)), size) for name, (size, _) in tails.items()}
    names = [f"__{name}" for name in tails]
    found = merged.withColumns(carried).filter(F.size(names[0]) > 0)
    return found.select(F.col(_SLICE).alias("__at"), *[F.col(k).alias(f"__key_{i}") for i, k in enumerate(keys)], *names)


def _last(values: Column, size: int) -> Column:
    return F.slice(values, F.greatest(F.size(values) - size + 1, F.lit(1)), F.lit(size))


def _with_tails(local: DataFrame, carried: DataFrame, tails: Mapping[str, tuple[int, Column]], keys: Sequence[str]) -> DataFrame:
    match = local[_SLICE] == carried["__at"]
    for i, key in enumerate(keys):
        match = match & local[key].eqNullSafe(carried[f"__key_{i}"])
    joined = local.join(F.broadcast(carried), match, "left")  # a row for each slice at most
    whole = lambda name, size: _last(F.concat(F.coalesce(f"__{name}", F.slice(name, 1, 0)), name), size)
    merged = {name: F.transform(whole(name, size), lambda x: x["v"]) for name, (size, _) in tails.items()}
    return joined.withColumns(merged).select(*local.columns)


def number_rows(df: DataFrame, order: Sequence[str], keys: Sequence[str] = (), name: str = "rn") -> DataFrame:
    """Row number from 1 within each key, or over the whole table without keys."""
    if keys:
        return running(df, {name: ("count", F.lit(1))}, order, keys)
    # Rows of a sorted slice carry their position in monotonically_increasing_id, so
    # numbering a whole table takes the range shuffle and no second one.
    placed = settle(
        df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__pos", F.monotonically_increasing_id())
    )
    inner = placed.withColumns(
        {_SLICE: F.shiftright("__pos", 33), name: F.col("__pos").bitwiseAND(F.lit((1 << 33) - 1)) + 1}
    ).drop("__pos")
    return _merge(inner, _carries(inner, {name: ("count", F.lit(1))}, ()), {name: "count"}, ()).drop(_SLICE)


def _carries(sliced: DataFrame, totals: Mapping[str, tuple[str, Column]], keys: Sequence[str]) -> DataFrame:
    """What earlier slices hold for a key: only for keys that were cut, one row per cut."""
    parts = sliced.groupBy(*keys, _SLICE).agg(
        *[_AGGREGATE[kind](value).alias(f"__{name}") for name, (kind, value) in totals.items()]
    )
    # The window sees one row per slice of a key, not the rows themselves.
    before = Window.partitionBy(*keys).orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    outer = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}
    return (
        parts.withColumn("__seen", F.count(F.lit(1)).over(before))
        .withColumns({f"__{name}": outer[kind](f"__{name}").over(before) for name, (kind, _) in totals.items()})
        .filter(F.col("__seen") > 0)
        .select(
            F.col(_SLICE).alias("__at"),
            *[F.col(k).alias(f"__key_{i}") for i, k in enumerate(keys)],
            *[f"__{name}" for name in totals],
        )
    )


def _merge(local: DataFrame, carries: DataFrame, kinds: Mapping[str, str], keys: Sequence[str]) -> DataFrame:
    match = local[_SLICE] == carries["__at"]
    for i, key in enumerate(keys):
        match = match & local[key].eqNullSafe(carries[f"__key_{i}"])
    joined = local.join(F.broadcast(carries), match, "left")
    merged = {
        name: F.when(F.col(f"__{name}").isNull(), F.col(name))
        .when(F.col(name).isNull(), F.col(f"__{name}"))
        .otherwise(_MERGE[kind](F.col(name), F.col(f"__{name}")))
        for name, kind in kinds.items()
    }
    return joined.withColumns(merged).select(*local.columns)


def with_halo(df: DataFrame, position: str, width: int, block: int) -> DataFrame:
    """Cut each key into blocks of ``block`` rows, each led by the ``width`` rows before it.

    Adds ``block`` and ``is_halo``. A frame that looks back at most ``width`` rows sees
    the same rows inside (key, block) as inside the key, so a hot key needs no task
    of its own; halo rows are dropped after the window.
    """
    if width > block:
        raise ValueError("a block must be at least as long as the frame")
    own = F.floor((F.col(position) - 1) / block)
    reach = F.floor((F.col(position) - 1 + width) / block)
    return (
        df.withColumn("__own", own)
        .withColumn("block", F.explode(F.array_distinct(F.array(own, reach))))
        .withColumn("is_halo", F.col("block") != F.col("__own"))
        .drop("__own")
    )
