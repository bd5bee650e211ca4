"""Shards cut from a Hilbert curve through the documents' metadata.

Labels, size and key of a document are quantised to 2**BITS cells each, and its place on the
Hilbert curve through these cells orders the documents: neighbours on the curve are alike in
every dimension, so a shard cut from the order has narrow bounds in all of them, and a filter
on any passes over most shards. Everything is an expression on columns. Texts are read once,
for their size and checksum; what is sorted is a narrow row.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tuneframe.plans.ordered import running
from tuneframe.session import settle

#: Cells of a dimension, as a power of two.
BITS = 5
CELLS = 1 << BITS
LAWS = ("rows", "bytes")


def octave(size: Column) -> Column:
    """Half octaves of a positive number: twice its binary digits less one, and its second digit; the last cell is open."""
    digits = F.length(F.bin(size))
    second = F.when(digits > 1, F.substring(F.bin(size), 2, 1).cast("long")).otherwise(0)
    return F.least(2 * (digits.cast("long") - 1) + second, F.lit(CELLS - 1)).cast("long")


def spread(value: Column, low: int | None, high: int | None) -> Column:
    """Cells of equal width from low to high; null is in the first."""
    if low is None:
        return F.lit(0).cast("long")
    wide = (value.cast("decimal(20,0)") - F.lit(low).cast("decimal(20,0)")) * F.lit(CELLS).cast("decimal(3,0)")
    return F.coalesce(F.call_function("div", wide, F.lit(high - low + 1).cast("decimal(20,0)")).cast("long"), F.lit(0).cast("long"))


def ranked(value: Column, bounds: Sequence[tuple[str, int]]) -> Column:
    """The cell of a label: that of the last of the ascending (first label, cell) that does not come after it."""
    if not bounds:
        return F.lit(0).cast("long")
    starts, cells = (F.array(*[F.lit(x) for x in part]) for part in zip(*bounds))
    return F.get(cells, F.size(F.filter(starts, lambda s: s <= value)) - 1).cast("long")


def label_bounds(rows: DataFrame, total: int) -> dict[int, list[tuple[str, int]]]:
    """For each place of `labels` the least label of each cell, where cells hold equally many rows.

    Labels are counted before they meet, so a label of a third of the rows is a row for each
    task. At most CELLS labels of a dimension come to the driver.
    """
    counts = rows.select(F.posexplode("labels").alias("dim", "value")).groupBy("dim", "value").agg(F.count("*").alias("n"))
    summed = running(counts, {"upto": ("sum", F.col("n"))}, ["value"], ["dim"])
    cell = F.expr(f"(upto - n) * {CELLS} div {total}").cast("int").alias("cell")
    found: dict[int, list[tuple[str, int]]] = {}
    for r in summed.select("dim", "value", cell).groupBy("dim", "cell").agg(F.min("value").alias("value")).collect():
        found.setdefault(r["dim"], []).append((r["value"], r["cell"]))
    return {dim: sorted(x, key=lambda b: b[1]) for dim, x in found.items()}


def curve_index(cells: Column, dims: int, bits: int = BITS) -> Column:
    """Place on the Hilbert curve of an array of `dims` cells, each from 0 to 2**bits - 1.

    The turns of each level are undone from the coarsest on, then the Gray code is taken and
    its digits are dealt together.
    """
    q = [1 << b for b in range(bits - 1, 0, -1)]
    steps = F.array(*[F.struct(F.lit(x).cast("long").alias("q"), F.lit(i).alias("i")) for x in q for i in range(dims)])

    def turn(x: Column, s: Column) -> Column:
        other = F.element_at(x, s["i"] + 1)
        first = F.element_at(x, F.lit(1))
        low = s["q"] - 1
        swap = first.bitwiseXOR(other).bitwiseAND(low)
        return F.transform(
            x,
            lambda v, j: F.when(other.bitwiseAND(s["q"]) != 0, F.when(j == 0, v.bitwiseXOR(low)).otherwise(v))
            .when((j == 0) | (j == s["i"]), v.bitwiseXOR(swap))
            .otherwise(v),
        )

    zero = F.lit(0).cast("long")
    turned = F.aggregate(steps, cells, turn) if q else cells
    gray = F.aggregate(  # each coordinate with all before it
        turned, F.array().cast("array<long>"), lambda a, v: F.concat(a, F.array(F.when(F.size(a) > 0, F.element_at(a, -1)).otherwise(zero).bitwiseXOR(v)))
    )
    powers = F.array(*[F.lit(x).cast("long") for x in q]) if q else F.array().cast("array<long>")
    digits = F.array(*[F.struct(F.lit(i + 1).alias("i"), F.lit(b).alias("b")) for b in range(bits - 1, -1, -1) for i in range(dims)])

    def fixed(x: Column) -> Column:
        last = F.element_at(x, F.lit(-1))
        return F.aggregate(powers, zero, lambda a, p: F.when(last.bitwiseAND(p) != 0, a.bitwiseXOR(p - 1)).otherwise(a))

    def dealt(x: Column) -> Column:
        return F.aggregate(digits, zero, lambda a, d: a * 2 + F.call_function("shiftright", F.element_at(x, d["i"]), d["b"]).bitwiseAND(F.lit(1).cast("long")))

    return bound(gray, lambda x: bound(fixed(x), lambda fix: bound(F.transform(x, lambda v: v.bitwiseXOR(fix)), dealt)))


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), where value is worked out once however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def sharded(
    df: DataFrame, n_shards: int = 16, text: str = "text", key: str = "doc_id", labels: Sequence[str] = ("lang", "source"), law: str = "rows", carry: Sequence[str] = ()
) -> DataFrame:
    """One row per row of df: key, size, text_crc32, law, shard, slot, grown_shard, curve, and `row` with the columns to carry.

    size is the text's UTF-8 bytes and one; curve the place on the Hilbert curve through labels,
    size and, where it is a whole number, key. By the law `rows` the counts of shards are at most
    one apart; by `bytes` a shard begins with the first row that begins in its equal share of all
    bytes. slot numbers the rows of a shard along the curve, from 0. A null text has no bytes and
    the checksum of an empty one; a null label counts as empty, a null key is in the first cell.
    Rows with equal cells are in order of key (null first), checksum and size, so copies and
    repeated rows are cut like any others. grown_shard is null: these laws move rows when shards
    are added. Labels that df lacks are no dimension; other columns are not looked at.
    """
    if law not in LAWS:
        raise ValueError(f"no law {law!r}; there are {LAWS}")
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    have = [c for c in labels if c in df.columns]
    rows = df.select(
        F.col(f"`{key}`").alias("key"),
        (F.octet_length(body) + 1).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        F.array(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in have]).cast("array<string>").alias("labels"),
        *([F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row")] if carry else []),
    )
    if not carry:
        rows = settle(rows)
    whole = isinstance(df.schema[key].dataType, T.IntegralType)
    ends = (F.min("key"), F.max("key")) if whole else (F.lit(None), F.lit(None))
    total, n_bytes, low, high = rows.agg(F.count("*"), F.sum("size"), *ends).first()
    bounds = label_bounds(rows, total) if have and total else {}
    cells = [ranked(F.get("labels", F.lit(i)), bounds.get(i, ())) for i in range(len(have))] + [octave(F.col("size"))]
    if whole:
        cells.append(spread(F.col("key"), low, high))
    placed = rows.withColumns({"curve": curve_index(F.array(*cells), len(cells)), "__id": F.monotonically_increasing_id()}).drop("labels")
    order = ["curve", "key", "text_crc32", "size", "__id"]
    laid = running(placed, {"__upto": ("count", F.lit(1)), "__end": ("sum", F.col("size"))}, order)
    if law == "rows":
        laid = laid.withColumn("shard", F.expr(f"(__upto - 1) * {n_shards} div {total or 1}"))
        slot = F.expr(f"__upto - 1 - (shard * {total} + {n_shards - 1}) div {n_shards}")
    else:
        laid = laid.withColumn("shard", F.expr(f"(__end - size) * {n_shards} div {n_bytes or 1}"))
        laid = settle(laid)
        first = laid.groupBy("shard").agg(F.min("__upto").alias("__first"))  # n_shards rows
        laid = laid.join(F.broadcast(first), "shard")
        slot = F.col("__upto") - F.col("__first")
    return laid.select(F.col("key").alias(key), "size", "text_crc32", F.lit(law).alias("law"), F.col("shard").cast("int").alias("shard"), slot.cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "curve", *(["row"] if carry else []))


def write_shards(df: DataFrame, path: str, text: str = "text", **how) -> DataFrame:
    """Write df's rows to a folder for each shard, in the order of the curve, and return them as read back.

    The folders add the column `shard`; a column of df with that name is left out. A row's
    bounds in every dimension are in the footers of its shard's files, which is what filters prune by.
    """
    names = [c for c in df.columns if c != "shard"]
    placed = sharded(df, text=text, carry=names, **how)
    rows = placed.sortWithinPartitions("shard", "slot").select("shard", *[F.col("row")[c].alias(c) for c in names])
    rows.write.mode("overwrite").partitionBy("shard").parquet(path)
    return df.sparkSession.read.parquet(path)
