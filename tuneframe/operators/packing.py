"""Order of samples in training: seeded shuffle, steps, and packing into full sequences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tuneframe.plans.ordered import number_rows, running
from tuneframe.session import settle


def shuffle_key(seed: int, key: Column) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}|"), key.cast("string")))


def seeded_shuffle(df: DataFrame, key: str, seed: int) -> DataFrame:
    """Add ``position`` from 0 in an order fixed by the seed and the sample keys.

    The hash spreads the keys evenly over range partitions whatever they look like. Rows
    without a key come first, and repeated keys stay beside each other; these are parted by where the table
    has them. The rows are written once and carry their positions through one shuffle.
    """
    keyed = settle(df.withColumns({"shuffle_key": shuffle_key(seed, F.col(key)), "__row": F.monotonically_increasing_id()}))
    numbered = number_rows(keyed, ["shuffle_key", key, "__row"], name="__rn")
    return numbered.select(*df.columns, "shuffle_key", (F.col("__rn") - 1).alias("position"))


def assign_steps(df: DataFrame, batch: int, accumulation: int, position: str = "position") -> DataFrame:
    """Optimizer step and micro-batch of each position; the last step may be short."""
    effective = batch * accumulation
    within = F.pmod(F.col(position), F.lit(effective))
    return df.withColumn("step", F.floor(F.col(position) / effective)).withColumn(
        "micro_batch", F.floor(within / batch)
    )


def pack_sequences(df: DataFrame, max_seq_length: int, *order: str, length: str = "length") -> DataFrame:
    """Lay the samples end to end and cut every ``max_seq_length`` tokens.

    Adds ``start`` and the first and last block a sample lies in, in the order of the named
    columns, nulls first; rows alike in all of them are laid out as the table has them. The rows are
    written once, so lengths are not worked out again for the sampling of ranges. A null length takes no room.
    """
    size = F.coalesce(F.col(length).cast("bigint"), F.lit(0).cast("bigint"))
    rows = settle(df.withColumn("__row", F.monotonically_increasing_id()))
    summed = running(rows, {"__end": ("sum", size)}, [*order, "__row"]).drop("__row")
    start = F.col("__end") - size
    last = start + F.greatest(size, F.lit(1)) - 1
    return summed.withColumns(
        {
            "start": start,
            "first_block": F.floor(start / max_seq_length),
            "last_block": F.floor(last / max_seq_length),
        }
    ).drop("__end")


def pack_blocks(packed: DataFrame, max_seq_length: int, length: str = "length") -> DataFrame:
    """Tokens and samples in every block; all but the last are full."""
    block = F.explode(F.sequence("first_block", "last_block")).alias("block")
    spans = packed.filter(F.col(length) > 0).select("start", F.col(length).alias("size"), block)
    begin = F.greatest("start", F.col("block") * max_seq_length)
    end = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * max_seq_length)
    return spans.groupBy("block").agg(F.sum(end - begin).alias("tokens"), F.count(F.lit(1)).alias("samples"))
