"""Token counts of documents of any length, exact, with huge documents cut into overlapping chunks.

A document beyond `chunk` characters becomes several rows, whose texts overlap by
`overlap` characters on either side of each cut. Chunks are encoded on their own with the
offsets of their tokens. Where a character that is no white space is followed by white
space, a byte-level vocabulary always ends a token, whatever stands before or after: such
an offset, found by both neighbours in the overlap, is where their counts are spliced.

Runs without white space (scripts that write none, encoded data) are spliced at borders of
the pattern's pieces. The pattern reads from left to right and looks ahead a few characters
at most, so a chunk whose beginning was spliced right knows the document's borders, but
those next to its end. Where the next chunk has a border at such an offset, both read on
alike from there, wherever that chunk began.

If two neighbours share none, the document is encoded again with wider overlaps, at last whole.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tuneframe.llm.bpe import WHITE
from tuneframe.llm.ship import as_key, hold, ship, with_key
from tuneframe.session import settle

_SPACE = WHITE.pattern[1:-2]
#: White space with the word behind it, or white space at the end: these never share a token.
PARTS = re.compile(f"[{_SPACE}]*[^{_SPACE}]+|[{_SPACE}]+")
CHUNK, OVERLAP = 32_768, 256
GROUP = 1 << 20
#: Parts whose tokens a worker remembers.
REMEMBERED = 400_000
#: What the pattern of the pieces looks ahead, and more: its contractions have two letters.
AHEAD = 16


class Counter:
    """Numbers of tokens of the parts of texts, remembered for the next time."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.table: dict[str, int] = {}
        self.scans = type(self.library.pre_tokenizer).__name__ == "ByteLevel"
        self.ahead = AHEAD + max((len(t.content) for t in self.library.get_added_tokens_decoder().values()), default=0)

    def learn(self, parts: set[str]) -> None:
        new = list(parts.difference(self.table))
        if len(self.table) + len(new) > REMEMBERED:
            self.table.clear()
            new = list(parts)
        for at in range(0, len(new), 20_000):
            some = new[at : at + 20_000]
            self.table.update(zip(some, map(len, self.library.encode_batch_fast(some, add_special_tokens=False))))

    def borders(self, part: str) -> list[tuple[int, int]]:
        """(end, tokens) of the pattern's pieces and of added tokens in a part."""
        made = self.library.encode(part, add_special_tokens=False)
        words, out, last = made.word_ids, [], 0
        for i, (word, following, (_, end)) in enumerate(zip(words, [*words[1:], None], made.offsets), 1):
            if word != following:
                out.append((end, i - last))
                last = i
        return out


@lru_cache(1)
def _counter(path: str) -> Counter:
    return Counter(path)


def counter(path: str) -> Counter:
    """The library and what it counted, which stay with the worker while this operator's tasks follow each other."""
    hold("counts", _counter.cache_clear)
    return _counter(path)


def ends(c: Counter, parts: list[str], counts: list[int], start: int, overlap: int, last: bool) -> tuple[np.ndarray, np.ndarray]:
    """Offsets in the document and tokens before them: where a chunk's parts end and, in long parts, their pieces.

    Left out are the chunk's own end and, unless it is the document's `last`, what its end may have moved.
    """
    at, tokens = [], []
    place, n = start, 0
    for i, (part, count) in enumerate(zip(parts, counts)):
        if len(part) > overlap and c.scans:
            final = i == len(parts) - 1 and not last
            inner, m = place, n
            for end, more in c.borders(part):
                m += more
                if end < len(part) and not (final and end > len(part) - c.ahead):
                    at.append(inner + end)
                    tokens.append(m)
        place, n = place + len(part), n + count
        if i < len(parts) - 1:
            at.append(place)
            tokens.append(n)
    return np.array(at, np.int64), np.array(tokens, np.int64)


def within(found: tuple[np.ndarray, np.ndarray], low: int, high: int) -> list[dict[str, int]]:
    at, before = found
    a, b = np.searchsorted(at, [low, high])
    return [{"at": x, "before": y} for x, y in zip(at[a:b].tolist(), before[a:b].tolist())]


def pieces(df: DataFrame, path: str, chunk: int, overlap: int) -> DataFrame:
    """df's columns but text; i, k: which of how many chunks; n: its tokens; l, r: its stable offsets at either end."""
    n = F.length("text")
    k = F.when(n > chunk, F.ceil(n / chunk)).otherwise(1).cast("int")
    cut = F.transform(
        F.sequence(F.lit(0), k - 1),
        lambda i: F.struct(i.alias("i"), F.when(k == 1, F.col("text")).otherwise(F.substring("text", F.greatest(i * chunk - overlap, F.lit(0)) + 1, chunk + overlap + F.when(i > 0, overlap).otherwise(0))).alias("part")),
    )
    rest = [c for c in df.columns if c != "text"]
    rows = df.select(*rest, k.alias("k"), F.explode(cut).alias("p")).select(*rest, "k", "p.i", "p.part")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c = counter(path)
        for pdf in batches:
            texts, at, out = pdf["part"].tolist(), 0, []
            while at < len(texts):
                group, size = [], 0
                while at + len(group) < len(texts) and (not group or size + len(texts[at + len(group)]) <= GROUP):
                    group.append(PARTS.findall(texts[at + len(group)]))
                    size += len(texts[at + len(group) - 1])
                if size <= GROUP:
                    c.learn(set().union(*group))
                    numbers = [list(map(c.table.__getitem__, parts)) for parts in group]
                else:  # one text beyond the usual size
                    numbers = [[]]
                    for start in range(0, len(group[0]), 100_000):
                        some = group[0][start : start + 100_000]
                        c.learn(set(some))
                        numbers[0] += map(c.table.__getitem__, some)
                for j, (parts, counts) in enumerate(zip(group, numbers), at):
                    i, k_ = int(pdf["i"].iat[j]), int(pdf["k"].iat[j])
                    left, right = [], []
                    if k_ > 1:
                        found = ends(c, parts, counts, max(0, i * chunk - overlap), overlap, i == k_ - 1)
                        left = within(found, i * chunk - overlap, i * chunk + overlap) if i > 0 else []
                        right = within(found, (i + 1) * chunk - overlap, (i + 1) * chunk + overlap) if i < k_ - 1 else []
                    out.append((sum(counts), left, right))
                at += len(group)
            n_, l_, r_ = zip(*out) if out else ((), (), ())
            yield pdf.drop(columns="part").assign(n=list(n_), l=list(l_), r=list(r_))

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.drop("part").schema)
    places = "array<struct<at: long, before: long>>"
    return rows.mapInPandas(count, f"{fields}, n long, l {places}, r {places}")


def spliced(cut: DataFrame, by: list[str]) -> DataFrame:
    """by and n_tokens of documents of several chunks; null where two chunks share no stable offset."""
    p = cut.filter("k > 1")
    left, right = p.filter("i < k - 1").select(*by, (F.col("i") + 1).alias("i"), F.col("n").alias("n_left"), "r"), p.select(*by, "i", "l")
    common = F.array_min(F.array_intersect("l.at", "r.at"))
    before = lambda side: F.get(F.filter(side, lambda y: y["at"] == F.col("x")), F.lit(0))["before"]
    edges = left.join(right, [*by, "i"]).withColumn("x", common).select(*by, F.lit(0).alias("n"), (F.col("n_left") - before("r") + before("l")).alias("over"), F.col("x").isNull().alias("failed"))
    both = p.select(*by, "n", F.lit(0).cast("long").alias("over"), F.lit(False).alias("failed")).unionByName(edges)
    return both.groupBy(*by).agg(F.when(~F.max("failed"), F.sum("n") - F.sum("over")).alias("n_tokens"))


def count_tokens(df: DataFrame, path: str, text: str = "text", key: str = "doc_id", limit: int = 1024, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """One row per row of df: key, n_bytes, n_tokens and over_limit (n_tokens > limit).

    A null text counts as empty: no bytes, no tokens. Repeated rows and null keys are kept;
    other columns are not looked at. `path` is readable on every executor.
    """
    ship(df.sparkSession)
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    docs = df.select(as_key(key), body.alias("text"))
    rows = docs.withColumns({"row": F.monotonically_increasing_id(), "n_bytes": F.octet_length("text").cast("long"), "same": F.when(F.length("text") > chunk, F.xxhash64("text")).otherwise(0)})
    first = settle(pieces(rows, path, chunk, overlap))
    short = first.filter("k = 1").select("key", "n_bytes", F.col("n").alias("n_tokens"))
    long = settle(first.filter("k > 1 AND i = 0").select("row", "key", "n_bytes", "same").join(spliced(first, ["row"]), "row"))
    while not (failed := long.filter("n_tokens IS NULL").select("same", "n_bytes").distinct()).isEmpty():
        overlap *= 8
        chunk = max(chunk, 4 * overlap)
        again = docs.select(F.xxhash64("text").alias("same"), F.octet_length("text").cast("long").alias("n_bytes"), "text")
        again = again.join(failed, ["same", "n_bytes"], "left_semi").dropDuplicates(["same", "n_bytes"])
        cut = settle(pieces(again, path, chunk, overlap))
        found = cut.filter("k = 1").select("same", "n_bytes", F.col("n").alias("found")).unionByName(spliced(cut, ["same", "n_bytes"]).withColumnRenamed("n_tokens", "found"))
        long = settle(long.join(found, ["same", "n_bytes"], "left").select("row", "key", "n_bytes", "same", F.coalesce("n_tokens", "found").alias("n_tokens")))
    out = short.unionByName(long.select("key", "n_bytes", "n_tokens"))
    return with_key(out.withColumn("over_limit", F.col("n_tokens") > limit), df, key)
