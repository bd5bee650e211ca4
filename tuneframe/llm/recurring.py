"""Keys that occur in two places of a table, counted in Spark and told to the rows that hold them.

Documents are dealt into batches. Each batch names its keys as one sorted block per
bucket of the key space; a bucket brings together the blocks of all batches, finds keys
that occur twice and answers each batch with those of its own. A key that one batch holds
many times is sent twice at most, so a hot key is no more than two entries per batch.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tuneframe.llm.ship import as_key, ship
from tuneframe.llm.words import mix

BLOCKS = "batch long, bucket int, keys binary"


def partitions_of(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def in_batches(df: DataFrame, text: str, key: str) -> DataFrame:
    """(batch, key, text), nothing else: two batches for each shuffle partition, the key as text."""
    ship(df.sparkSession)
    n = 2 * partitions_of(df)
    k, t = F.col(f"`{key}`"), F.col(f"`{text}`")
    batch = F.pmod(F.xxhash64(k, t), F.lit(n)).cast("long")
    return df.select(batch.alias("batch"), as_key(key), t.alias("text"))


def blocks(batch: int, keys: np.ndarray, n_buckets: int, seed: np.ndarray | None = None, kind=np.uint64) -> pd.DataFrame:
    """Rows (batch, bucket, keys): distinct keys, those that occur more than once twice.

    The bucket comes from `seed`, a second hash of the same thing, or from the key itself;
    `kind` may be narrower than the key where false matches do no harm.
    """
    bucket = ((keys if seed is None else seed) >> np.uint64(40)) % np.uint64(n_buckets)
    narrow = keys.astype(kind)
    order = np.lexsort((narrow, bucket))
    narrow, bucket = narrow[order], bucket[order]
    n = len(narrow)
    if not n:
        return pd.DataFrame({"batch": [], "bucket": [], "keys": []})
    same = np.zeros(n, bool)
    same[1:] = (narrow[1:] == narrow[:-1]) & (bucket[1:] == bucket[:-1])
    third = np.zeros(n, bool)
    third[1:] = same[1:] & same[:-1]
    narrow, bucket = narrow[~third], bucket[~third]
    cuts = np.flatnonzero(np.diff(bucket)) + 1
    starts = np.concatenate([[0], cuts])
    return pd.DataFrame({"batch": batch, "bucket": bucket[starts].astype(np.int32), "keys": [x.tobytes() for x in np.split(narrow, cuts)]})


def recurring(blocks_df: DataFrame, kind=np.uint64, counts: bool = False) -> DataFrame:
    """(batch, bucket, keys[, counts]): of each batch's keys in a bucket, those that occur twice anywhere.

    `counts` adds how often each key was named, as a byte: eight times its base-2 logarithm.
    """

    def answer(pdf: pd.DataFrame) -> pd.DataFrame:
        parts = [np.frombuffer(x, kind) for x in pdf["keys"]]
        values, times = np.unique(np.concatenate(parts), return_counts=True)
        values, times = values[times > 1], times[times > 1]
        levels, rows = (8 * np.log2(times)).astype(np.uint8), []
        for batch, bucket, part in zip(pdf["batch"], pdf["bucket"], parts):
            at = np.searchsorted(values, part)
            at[at == len(values)] = 0
            found = values[at] == part if len(values) else np.zeros(len(part), bool)
            found[1:] &= part[1:] != part[:-1]
            if found.any():
                rows.append((batch, bucket, part[found].tobytes(), levels[at[found]].tobytes()))
        return pd.DataFrame(rows, columns=["batch", "bucket", "keys", "counts"])

    told = blocks_df.groupBy("bucket").applyInPandas(answer, BLOCKS + ", counts binary")
    return told if counts else told.drop("counts")


def second(keys: np.ndarray) -> np.ndarray:
    """Another 64 bits made from a key."""
    return mix(keys ^ np.uint64(0x5851F42D4C957F2D))
