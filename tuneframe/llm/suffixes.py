"""Suffix-array dedup: passages of at least `min_words` words that occur twice, found from sparse suffixes.

1. Of the windows of min_words words, each keeps the run of `gram` words with the least
   hash (its minimiser). Equal windows keep the same run, so a passage that occurs twice
   holds a kept position in both places. Only suffixes at kept positions are looked at.
2. `recurring` finds the kept runs that occur twice; for those, the words to the right and
   the left of the position are sent to the bucket of the run, equal contexts of one batch once.
3. A bucket sorts its suffixes by the words to the right and measures the common words of
   neighbours. For every length of a common beginning, the suffixes that share it are
   compared with their neighbours in the order of the words to the left, which gives the
   longest extension to the left. Where both sides add up to min_words, the match counts.
4. Contexts reach as far as the next kept position, so the matches of a document merge
   into maximal intervals.

Words are compared by 32 bits of their hashes; min_words of them have to agree. Defined
cases: null, blank and shorter texts have no repeats; equal rows are two occurrences; a
null key is carried through; other columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from tuneframe.llm.recurring import BLOCKS, blocks, in_batches, partitions_of, recurring, second
from tuneframe.llm.ship import with_key
from tuneframe.llm.substrings import kept_texts, spans
from tuneframe.llm.words import Words, mix, pieces

CONTEXTS = "batch long, bucket int, contexts binary, many binary"
MATCHES = "batch long, names binary, left binary, right binary"


def sliding(values: np.ndarray, width: int, pick: np.ufunc, fill: int) -> np.ndarray:
    """pick (least or greatest) of every `width` neighbours, in time that does not depend on the width."""
    n = len(values)
    if n < width:
        return values[:0]
    padded = np.full(-(-n // width) * width, fill, values.dtype)
    padded[:n] = values
    rows = padded.reshape(-1, width)
    before = pick.accumulate(rows, axis=1).ravel()
    after = pick.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return pick(after[: n - width + 1], before[width - 1 : n])


def minimisers(w: Words, gram: int, min_words: int) -> tuple[np.ndarray, np.ndarray]:
    """First word and hash of the kept runs."""
    at, keys = w.windows(gram)
    n = len(w.starts)
    if n < min_words:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    width = min_words - gram + 1
    hashes = np.full(n - gram + 1, np.iinfo(np.uint64).max, np.uint64)
    hashes[at] = np.maximum(keys, np.uint64(1))
    least = sliding(hashes, width, np.minimum, np.iinfo(np.uint64).max)
    least[w.doc[: len(least)] != w.doc[min_words - 1 :]] = 0
    edge = np.zeros(width - 1, np.uint64)
    greatest = sliding(np.concatenate([edge, least, edge]), width, np.maximum, 0)
    kept = np.flatnonzero(greatest == hashes)
    return kept, hashes[kept]


def contexts(w: Words, at: np.ndarray, left: int, right: int) -> np.ndarray:
    """A row for each position: the words before it, nearest first, then those from it on; 0 beyond the text."""
    words = np.maximum((w.hashes & np.uint64(0xFFFFFFFF)).astype(np.uint32), np.uint32(1))
    where = at[:, None] + np.concatenate([-1 - np.arange(left), np.arange(right)])
    inside = (where >= w.first[w.doc[at]][:, None]) & (where < w.first[w.doc[at] + 1][:, None])
    return np.where(inside, words[np.clip(where, 0, len(words) - 1)], np.uint32(0))


def names_of(rows: np.ndarray) -> np.ndarray:
    """A 64-bit name of each context."""
    factors = mix(np.arange(1, rows.shape[1] + 1, dtype=np.uint64)) | np.uint64(1)
    return mix((mix(rows.astype(np.uint64)) * factors).sum(axis=1))


def common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many first words two rows share; nothing is shared beyond a text."""
    differ = (a != b) | (a == 0)
    return np.where(differ.any(axis=1), differ.argmax(axis=1), a.shape[1])


def _order(rows: np.ndarray) -> np.ndarray:
    return np.argsort(np.ascontiguousarray(rows).view(f"S{4 * rows.shape[1]}").ravel(), kind="stable")


def match(rows: np.ndarray, many: np.ndarray, left: int, gram: int, min_words: int) -> tuple[np.ndarray, np.ndarray]:
    """For each context the words to the left and right that it shares in matches, 0 and 0 without one."""
    before, behind = rows[:, :left], rows[:, left:]
    best_left, best_right = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
    own_left, own_right = (before != 0).sum(axis=1), (behind != 0).sum(axis=1)
    whole = many & (own_left + own_right >= min_words)
    best_left[whole], best_right[whole] = own_left[whole], own_right[whole]
    if len(rows) < 2:
        return best_left, best_right
    suffixes = _order(behind)
    shared = np.concatenate([[0], common(behind[suffixes[1:]], behind[suffixes[:-1]])])
    by_left = np.empty(len(rows), np.int64)
    by_left[_order(before)] = np.arange(len(rows))
    for length in range(behind.shape[1], gram - 1, -1):
        group = np.cumsum(shared < length)
        partner = np.zeros(len(rows), bool)
        partner[1:] = shared[1:] >= length
        partner[:-1] |= partner[1:].copy()
        inside = np.flatnonzero(partner)
        if not len(inside):
            continue
        one = suffixes[inside]
        order = np.lexsort((by_left[one], group[inside]))
        one, groups = one[order], group[inside][order]
        extra = np.where(groups[1:] == groups[:-1], common(before[one[1:]], before[one[:-1]]), -1)
        reach = np.maximum(np.append(extra, -1), np.concatenate([[-1], extra]))
        ok = reach + length >= min_words
        best_left[one[ok]] = np.maximum(best_left[one[ok]], reach[ok])
        best_right[one[ok]] = np.maximum(best_right[one[ok]], length)
    return best_left, best_right


def repeated_passages(df: DataFrame, text: str = "text", key: str = "doc_id", min_words: int = 50, gram: int = 8) -> DataFrame:
    """One row per row of df: key, kept_text, n_words, n_repeated, repeated (word intervals)."""
    docs = in_batches(df, text, key)
    n_buckets = partitions_of(df)
    left, right = min_words - gram, min_words

    def name(pdf: pd.DataFrame) -> pd.DataFrame:
        keys = [minimisers(Words(group), gram, min_words)[1] for _, group in pieces(pdf["text"].tolist())]
        return blocks(pdf["batch"].iloc[0], np.concatenate(keys), n_buckets)

    def send(pdf: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        known = np.sort(np.frombuffer(b"".join(told["keys"]), np.uint64)) if len(told) else np.zeros(0, np.uint64)
        found = [(np.zeros(0, np.uint64), np.zeros((0, left + right), np.uint32))]
        for _, group in pieces(pdf["text"].tolist()) if len(known) else ():
            w = Words(group)
            at, keys = minimisers(w, gram, min_words)
            at_known = known[np.minimum(np.searchsorted(known, keys), len(known) - 1)] == keys
            found.append((keys[at_known], contexts(w, at[at_known], left, right)))
        keys, rows = (np.concatenate(x) for x in zip(*found))
        _, first, times = np.unique(names_of(rows), return_index=True, return_counts=True) if len(rows) else (0, np.zeros(0, int), np.zeros(0, int))
        bucket = second(keys[first]) % np.uint64(n_buckets)
        order = np.argsort(bucket, kind="stable")
        first, times, bucket = first[order], times[order], bucket[order]
        cuts = np.flatnonzero(np.diff(bucket)) + 1
        out = [(pdf["batch"].iloc[0], int(bucket[x[0]]), rows[first[x]].tobytes(), (times[x] > 1).tobytes()) for x in np.split(np.arange(len(first)), cuts) if len(x)]
        return pd.DataFrame(out, columns=["batch", "bucket", "contexts", "many"])

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        parts = [np.frombuffer(x, np.uint32).reshape(-1, left + right) for x in pdf["contexts"]]
        rows = np.concatenate(parts)
        best_left, best_right = match(rows, np.frombuffer(b"".join(pdf["many"]), bool), left, gram, min_words)
        names, cuts, out = names_of(rows), np.cumsum([0] + [len(x) for x in parts]), []
        for batch, a, b in zip(pdf["batch"], cuts[:-1], cuts[1:]):
            ok = a + np.flatnonzero(best_right[a:b])
            if len(ok):
                out.append((batch, names[ok].tobytes(), best_left[ok].astype(np.uint8).tobytes(), best_right[ok].astype(np.uint8).tobytes()))
        return pd.DataFrame(out, columns=["batch", "names", "left", "right"])

    def cut(pdf: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        names, before, behind = np.zeros(0, np.uint64), np.zeros(0, np.uint8), np.zeros(0, np.uint8)
        if len(told):
            names, before, behind = (np.frombuffer(b"".join(told[c]), t) for c, t in (("names", np.uint64), ("left", np.uint8), ("right", np.uint8)))
            order = np.argsort(names)
            names, before, behind = names[order], before[order].astype(np.int64), behind[order].astype(np.int64)
        out = []
        for first, group in pieces(pdf["text"].tolist()):
            w = Words(group)
            steps = np.zeros(len(w.starts) + 1, np.int64)
            if len(names):
                at, _ = minimisers(w, gram, min_words)
                for a in range(0, len(at), 20_000):
                    some = at[a : a + 20_000]
                    own = names_of(contexts(w, some, left, right))
                    where = np.minimum(np.searchsorted(names, own), len(names) - 1)
                    ok = names[where] == own
                    np.add.at(steps, some[ok] - before[where[ok]], 1)
                    np.add.at(steps, some[ok] + behind[where[ok]], -1)
            drop = np.cumsum(steps[:-1]) > 0
            removed = np.diff(np.concatenate([[0], np.cumsum(drop)])[w.first])
            kept = [x.decode("utf-8", "surrogatepass") for x in kept_texts(w, drop)]
            out.append(pd.DataFrame({"key": pdf["key"].iloc[first : first + len(group)].array, "kept_text": kept, "n_words": w.counts, "n_repeated": removed, "repeated": spans(w, drop)}))
        return pd.concat(out)

    grouped = docs.groupBy("batch")
    told = recurring(grouped.applyInPandas(name, BLOCKS))
    sent = docs.groupBy("batch").cogroup(told.groupBy("batch")).applyInPandas(send, CONTEXTS)
    matches = sent.groupBy("bucket").applyInPandas(compare, MATCHES)
    schema = "key string, kept_text string, n_words long, n_repeated long, repeated string"
    made = docs.groupBy("batch").cogroup(matches.groupBy("batch")).applyInPandas(cut, schema)
    return with_key(made, df, key)
