"""Substring dedup: token windows that occur twice anywhere are cut from every document.

Rabin-Karp hashes of every window of a fixed number of words are counted in Spark
(`recurring`); in each document, repeated windows merge into maximal intervals of words.

Two windows count as equal when a 64-bit hash and the bucket, taken from a second,
independent hash, agree. Defined cases: a null or blank text has no words and stays
empty; a text shorter than the window keeps all words; rows with equal key and text are
two occurrences; a null key is carried through; other columns are not looked at.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from tuneframe.llm.recurring import BLOCKS, blocks, in_batches, partitions_of, recurring
from tuneframe.llm.ship import with_key
from tuneframe.llm.words import SECOND_BASE, Words, member, pieces


def covered(n: int, first_words: np.ndarray, width: int) -> np.ndarray:
    """Which of n words lie in a window of `width` words that starts at one of first_words."""
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, first_words, 1)
    np.add.at(steps, first_words + width, -1)
    return np.cumsum(steps[:-1]) > 0


def kept_texts(w: Words, drop: np.ndarray) -> list[bytes]:
    """Each text's words without the dropped ones, joined by one space."""
    keep = np.zeros(len(w.data) + 1, np.int8)
    keep[w.starts[~drop]] += 1
    np.add.at(keep, np.minimum(w.ends[~drop] + 1, len(w.data)), -1)
    inside = np.cumsum(keep[:-1], dtype=np.int8) > 0
    data = w.data.copy()
    data[w.ends] = 32
    lengths = np.concatenate([[0], np.cumsum(inside)])[w.text_starts]
    flat = data[inside].tobytes()
    return [flat[a : b - 1] if b > a else b"" for a, b in zip(lengths[:-1], lengths[1:])]


def spans(w: Words, drop: np.ndarray) -> list[str]:
    """Each text's maximal runs of dropped words as start:end, comma-joined."""
    edge = np.flatnonzero(np.diff(np.concatenate([[False], drop, [False]]).astype(np.int8)))
    if not len(edge):
        return [""] * len(w.counts)
    # a run that goes on into the next text is cut there
    flags = np.zeros(len(drop) + 1, bool)
    flags[edge] = True
    inner = w.first[1:-1]
    both = inner[(inner > 0) & (inner < len(drop))]
    both = np.unique(both)
    both = both[drop[both] & drop[both - 1]]
    starts = np.sort(np.concatenate([edge[0::2], both]))
    ends = np.sort(np.concatenate([edge[1::2], both]))
    doc = w.doc[starts]
    out: list[list[str]] = [[] for _ in w.counts]
    for d, a, b in zip(doc.tolist(), (starts - w.first[doc]).tolist(), (ends - w.first[doc]).tolist()):
        out[d].append(f"{a}:{b}")
    return [",".join(x) for x in out]


def remove_repeated(df: DataFrame, text: str = "text", key: str = "doc_id", window: int = 35) -> DataFrame:
    """One row per row of df: key, text, kept_text, n_words, n_removed, removed (word intervals)."""
    docs = in_batches(df, text, key)
    n_buckets = partitions_of(df)

    def name(pdf: pd.DataFrame) -> pd.DataFrame:
        keys, seeds = [], []
        for _, group in pieces(pdf["text"].tolist()):
            w = Words(group)
            keys.append(w.windows(window)[1])
            seeds.append(w.windows(window, SECOND_BASE)[1])
        return blocks(pdf["batch"].iloc[0], np.concatenate(keys), n_buckets, np.concatenate(seeds))

    def cut(pdf: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        found = np.sort(np.frombuffer(b"".join(told["keys"]), np.uint64)) if len(told) else np.zeros(0, np.uint64)
        out = []
        for at, group in pieces(pdf["text"].tolist()):
            w = Words(group)
            where, keys = w.windows(window)
            drop = covered(len(w.starts), where[member(keys, found)], window)
            removed = np.diff(np.concatenate([[0], np.cumsum(drop)])[w.first])
            kept = [x.decode("utf-8", "surrogatepass") for x in kept_texts(w, drop)]
            out.append(pd.DataFrame({"key": pdf["key"].iloc[at : at + len(group)].array, "kept_text": kept, "n_words": w.counts, "n_removed": removed, "removed": spans(w, drop)}))
        return pd.concat(out)

    told = recurring(docs.groupBy("batch").applyInPandas(name, BLOCKS))
    schema = "key string, kept_text string, n_words long, n_removed long, removed string"
    made = docs.groupBy("batch").cogroup(told.groupBy("batch")).applyInPandas(cut, schema)
    return with_key(made, df, key)


def sha256(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()
