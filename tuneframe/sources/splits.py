"""Readers of raw datasets."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tuneframe.plans.ordered import number_rows


def load_splits(spark: SparkSession, paths: Mapping[str, str], split: str | None = "all") -> DataFrame:
    """One split, or all of them in one table with a ``split`` column.

    The name is checked before any data is read.
    """
    if split not in (None, "all") and split not in paths:
        raise ValueError(f"no split {split!r}; available: {', '.join(paths)}")
    wanted = list(paths) if split in (None, "all") else [split]
    parts = [spark.read.parquet(paths[name]).withColumn("split", F.lit(name)) for name in wanted]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def load_jsonl(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def limit_samples(df: DataFrame, n: int, order_key: str) -> DataFrame:
    """The first ``n`` rows by a key, exactly; 0 keeps everything.

    Null keys come first; rows of equal keys are taken in the order of their other columns.
    Keys alone are numbered, in parallel, and the rows are read by a filter on the n-th.
    """
    if n <= 0:
        return df
    numbered = number_rows(df.select(F.col(order_key).alias("key")), ["key"])
    last = numbered.filter(F.col("rn") == n).select("key").first()
    if last is None:
        return df
    key, bound = F.col(order_key), F.lit(last["key"]).cast(df.schema[order_key].dataType)
    ties = numbered.filter(F.col("key").eqNullSafe(bound)).agg(F.min("rn").alias("first"), F.max("rn").alias("last")).first()
    earlier = (F.lit(False) if last["key"] is None else key.isNull()) | F.coalesce(key < bound, F.lit(False))
    same = key.eqNullSafe(bound)
    if ties["last"] == n:
        return df.filter(earlier | same)
    others = [c for c in df.columns if c != order_key]
    return df.filter(earlier).unionByName(df.filter(same).orderBy(*others).limit(n - ties["first"] + 1))
