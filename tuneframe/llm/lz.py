"""Lempel-Ziv phrase fingerprints: documents that compress alike have like signatures.

A text is read as symbols: runs of up to 16 characters that are no white space, each with
the white space before it. LZ78 parsing cuts the symbols into phrases, each one symbol
longer than a phrase met before. The fingerprint is the bottom sketch of the hashed phrase
set, its SIZE least 32-bit hashes, and two sketches estimate the Jaccard similarity of the sets.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tuneframe.llm.recurring import partitions_of
from tuneframe.llm.ship import as_key, ship, with_key
from tuneframe.llm.words import mix

SIZE = 128
SYMBOLS = re.compile(r"\s*\S{1,16}|\s+")
#: Symbols of a long text that are held at once.
STEP = 1 << 16
_FACTOR, _MASK = 0x9E3779B97F4A7C15, (1 << 64) - 1


class Phrases:
    """The phrase set of a text that is read bit by bit."""

    def __init__(self, seen: set[int] | None = None, state: int = 0):
        self.seen, self.state = seen if seen is not None else set(), state

    def read(self, symbols: list[str]) -> None:
        seen, state = self.seen, self.state
        add = seen.add
        for symbol in symbols:
            # a phrase is named by the name of the phrase it extends and its last symbol
            state = ((state ^ crc32(symbol.encode("utf-8", "surrogatepass"))) * _FACTOR + len(symbol)) & _MASK
            state ^= state >> 29
            if state not in seen:
                add(state)
                state = 0
        self.state = state

    def signature(self) -> np.ndarray:
        """The SIZE least hashes; a phrase begun at the end of the text counts too."""
        names = np.fromiter(self.seen, np.uint64, len(self.seen))
        if self.state:
            names = np.append(names, np.uint64(self.state ^ 0x5555))
        hashes = np.unique(mix(names) >> np.uint64(32)).astype("<u4")
        return hashes[:SIZE]


def symbols(text: str) -> Iterator[list[str]]:
    found: list[str] = []
    for m in SYMBOLS.finditer(text) if len(text) > 4 * STEP else ():
        found.append(m[0])
        if len(found) == STEP:
            yield found
            found = []
    yield found if len(text) > 4 * STEP else SYMBOLS.findall(text)


def signature(text: str) -> np.ndarray:
    phrases = Phrases()
    for some in symbols(text):
        phrases.read(some)
    return phrases.signature()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated Jaccard similarity of two phrase sets; two empty ones are alike."""
    if not len(a) and not len(b):
        return 1.0
    union = np.union1d(a, b)[:SIZE]
    both = np.intersect1d(np.intersect1d(a, b, assume_unique=True), union, assume_unique=True)
    return float(len(both)) / len(union)


def packed(a: np.ndarray) -> str:
    return base64.b64encode(a.tobytes()).decode()


def unpacked(fingerprint: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(fingerprint), "<u4")


def fingerprints(df: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per row of df: key, n_chars, fingerprint. A null text counts as empty."""
    ship(df.sparkSession)
    rows = df.select(as_key(key), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))

    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"key": pdf["key"], "n_chars": pdf["text"].map(len), "fingerprint": pdf["text"].map(lambda t: packed(signature(t)))})

    return with_key(rows.mapInPandas(make, "key string, n_chars long, fingerprint string"), df, key)


def compare_fingerprints(df: DataFrame, left: str, right: str, name: str = "likeness") -> DataFrame:
    """df with the likeness of two fingerprint columns, null where one is."""
    ship(df.sparkSession)
    both = lambda a, b: pd.Series([likeness(unpacked(x), unpacked(y)) if x is not None and y is not None else None for x, y in zip(a, b)], dtype=float)
    return df.withColumn(name, F.pandas_udf(both, "double")(F.col(f"`{left}`"), F.col(f"`{right}`")))


def edited_text(text: str, following: str) -> str:
    """The last floor(n/2) characters replaced by the first as many (or all) of the following text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


#: Bytes of a text's beginning that part rows of one key.
BEGINNING = 7


def _runs(df: DataFrame, text: str, key: str) -> DataFrame:
    """(run, key, order, text, head): rows dealt into runs of neighbouring keys, counted from the greatest on.

    Rows without a key, and those of a key that fills a run, are parted further by how their texts begin, which
    is the order within a key. The row that follows the last of a run, the first of a later run, is in it as a head.
    Quantiles of keys and of beginnings and the numbers of the runs that have rows go through the driver, a few
    numbers for each run, of which there are some four for a shuffle partition.
    """
    n = 4 * partitions_of(df)
    step = [i / n for i in range(1, n)]
    kind = df.schema[key].dataType
    begins = F.conv(F.rpad(F.hex(F.substring(F.col("text").cast("binary"), 1, BEGINNING)), 2 * BEGINNING, "0"), 16, 10).cast("long")
    rows = df.select(as_key(key), F.col(f"`{key}`").alias("order"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    quantiles = sorted(df.select(key).stat.approxQuantile(key, step, 1 / (4 * n)))
    bounds = np.array(sorted(set(quantiles)))
    hot = [b for a, b in zip(quantiles, quantiles[1:]) if a == b]  # no more keys than quantiles
    many = F.col("order").isNull() | F.col("order").isin([F.lit(x).cast(kind) for x in sorted(set(hot))])
    cuts = sorted(set(rows.filter(many).select(begins.alias("b")).stat.approxQuantile("b", step, 1 / (4 * n))))
    passed = lambda value, at: F.size(F.filter(F.array(*[F.lit(float(x)) for x in at]).cast("array<double>"), lambda x: x <= value))
    base = F.when(F.col("order").isNull(), len(bounds) + 1).otherwise(len(bounds) - passed(F.col("order").cast("double"), bounds))
    part = F.when(many, 1 + passed(begins.cast("double"), cuts)).otherwise(0)
    placed = rows.withColumn("run", (base * (n + 2) + part).cast("int"))
    first = placed.groupBy("run").agg(F.max("order").alias("order"))
    full = sorted(r["run"] for r in first.select("run").collect())
    earlier = df.sparkSession.createDataFrame([(full[i], full[i - 1]) for i in range(len(full))], "run int, before int")  # the first run follows the last one
    # a number for each run is broadcast, so that no text moves to find the first of a run
    least = placed.join(F.broadcast(first.withColumnRenamed("order", "greatest")), "run").filter(F.col("order").eqNullSafe(F.col("greatest"))).groupBy("run").agg(F.min("text").alias("text"))
    heads = least.join(earlier, "run").select(F.col("before").alias("run"), F.lit(None).cast("string").alias("key"), F.lit(None).cast(kind).alias("order"), "text", F.lit(True).alias("head"))
    return placed.select("run", "key", "order", "text", F.lit(False).alias("head")).unionByName(heads)


def edit_likeness(df: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Fingerprints of each text and its edited text, and their likeness.

    One row per row of df: key, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited (text and edited text), near_next (text and next document). The edited
    text ends with the beginning of the next document in descending order of the numeric
    key, null keys last; the first document follows the last. Rows of equal keys are in
    order of their texts. A null text counts as empty.
    """
    ship(df.sparkSession)
    dealt = _runs(df, text, key)

    def walk(pdf: pd.DataFrame) -> pd.DataFrame:
        own = pdf[~pdf["head"]].sort_values(["order", "text"], ascending=[False, True], na_position="last")
        heads = pdf[pdf["head"]].sort_values("text")
        texts = own["text"].tolist() + heads["text"].tolist()
        out, following = [], None
        for i in range(len(texts) - 1, -1, -1):
            t = texts[i]
            if i == len(own):
                following = signature(t)
                continue
            if following is None:
                following = signature(texts[i + 1])
            mine = signature(t)
            edited = edited_text(t, texts[i + 1])
            changed = mine if edited == t else signature(edited)
            out.append((own["key"].iat[i], len(t), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), packed(mine), packed(changed), likeness(mine, changed), likeness(mine, following)))
            following = mine
        return pd.DataFrame(out, columns=["key", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    schema = "key string, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return with_key(dealt.groupBy("run").applyInPandas(walk, schema), df, key)
