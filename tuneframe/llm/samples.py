"""Bounded samples of labelled texts, for models that are trained on the driver."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def labelled_texts(df: DataFrame, marks: DataFrame, text: str, key: str, wanted: Mapping, max_chars: int) -> list[tuple]:
    """(label, text) of up to wanted[label] rows of each label, sorted; the first by a hash of the key.

    marks has a key and a label for each labelled key. Rows are chosen by keys, lengths and
    hashes alone; then the texts of the chosen, no more than wanted, are read. Rows
    without key or text, and texts over max_chars, are not chosen; equal rows are one.
    """
    k, t = F.col(f"`{key}`"), F.col(f"`{text}`")
    known = df.filter(F.length(t) <= max_chars).select(k.alias("key"), F.xxhash64(t).alias("same")).join(marks, "key").distinct()
    known = known.withColumn("order", F.xxhash64("key"))
    parts = [known.filter(F.col("label") == label).orderBy("order", "same").limit(n) for label, n in wanted.items()]
    chosen = parts[0]
    for part in parts[1:]:
        chosen = chosen.unionByName(part)
    texts = df.select(k.alias("key"), t.alias("text"), F.xxhash64(t).alias("same"))
    found = texts.join(F.broadcast(chosen), ["key", "same"]).dropDuplicates(["key", "same"])
    return sorted((r["label"], r["text"]) for r in found.select("label", "text").collect())
