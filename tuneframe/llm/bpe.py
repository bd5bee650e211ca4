"""Exact BPE ids by per-prefix dynamic programming, and their decoding.

For each piece of a text, an automaton over the vocabulary lists every token that ends
at each position (all vocabulary suffixes of each prefix, longest first). A token can be
the last one of a prefix if it is compatible with the last token of the prefix before it:
no merge across their border comes before the merges that built the two. Exactly one
token is, so one entry per prefix is stored; back-pointers then give the ids.

Spark deals out the documents; a worker keeps the ids of pieces for the next time they occur,
in tables of bounded size, until another operator's turn.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterator
from functools import cached_property, lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tuneframe.llm.ship import as_key, hold, ship, with_key

#: Bytes of a generation of each table that a worker remembers; there are two of a table at most.
REMEMBERED = 40 << 20
#: Bytes of an entry beside its letters and ids, and of a remembered pair.
ENTRY, PAIR = 190, 110
#: White space as the normaliser knows it: Unicode's, without the four separators 1C to 1F.
WHITE = re.compile("[\t-\r \x85\xa0  -     　]+")
#: Long texts are worked on in slices of about so many characters, cut at white space.
SLICE = 1 << 20
#: Characters of texts whose ids are handed on together.
HANDED = 1 << 20
FOREIGN = re.compile("[^\x00-\xff]")
#: What a text has to be read chunk by chunk for.
UNUSUAL = re.compile("[^\x00-\x1b\x20-\xff]")
END = ""


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class Merges:
    """Ranks of a BPE vocabulary and the test of neighbouring tokens."""

    def __init__(self, vocab: dict[str, int], merges: list):
        self.rank = dict.fromkeys(vocab.values(), -1)
        self.left: dict[int, int] = {}
        self.right: dict[int, int] = {}
        self.pair: dict[tuple[int, int], int] = {}
        for rank, merge in enumerate(merges):
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            token = vocab[a + b]
            first, second = vocab[a], vocab[b]
            self.pair[first, second] = rank
            self.rank[token], self.left[token], self.right[token] = rank, first, second
        self.known = Remembered(lambda key: self._compatible(key >> 20, key & 0xFFFFF), lambda key, fits: 2 * PAIR)

    def compatible(self, a: int, b: int) -> bool:
        """Whether a and b stay two tokens when their letters stand side by side."""
        return self.known[a << 20 | b]

    def builds(self, token: int) -> bool:
        """Whether the two parts of a token stay two until the token's own merge."""
        return self._compatible(self.left[token], self.right[token], self.rank[token])

    def _compatible(self, a: int, b: int, before: float = float("inf")) -> bool:
        # Undo merges from the latest on; a merge across the border must not precede the last one undone.
        while True:
            across = self.pair.get((a, b))
            if across is not None and across < before:
                return False
            rank_a, rank_b = self.rank[a], self.rank[b]
            if rank_a < 0 and rank_b < 0:
                return True
            if rank_a > rank_b:
                before, a = rank_a, self.right[a]
            else:  # among equal merges the one further left comes first
                before, b = rank_b + 1, self.left[b]


def latin(pattern: str) -> re.Pattern:
    """A pattern of pieces for text up to U+00FF, with its classes written out, which `re` reads twice as fast."""
    import regex

    for name in (r"\p{L}", r"\p{N}", r"\s"):
        pattern = pattern.replace(name, "".join(re.escape(chr(i)) for i in range(256) if regex.match(name, chr(i))))
    return re.compile(pattern)


class WordBpe:
    """A BPE vocabulary with an end-of-word mark, its normaliser and its pieces."""

    def __init__(self, path: str):
        import ahocorasick

        spec = json.loads(open(path, encoding="utf-8").read())
        model = spec["model"]
        vocab: dict[str, int] = model["vocab"]
        self.mark = model["end_of_word_suffix"]
        self.merges = Merges(vocab, model["merges"])
        self.token = {i: t for t, i in vocab.items()}
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.token |= {i: t for t, i in self.special.items()}
        self.letters = byte_letters()
        self.automaton = ahocorasick.Automaton()
        self.length = [0] * (max(self.token) + 1)
        for text, i in vocab.items():
            if i in self.special.values():
                continue
            body = text.removesuffix(self.mark)
            ends = text.endswith(self.mark) and body != ""
            self.automaton.add_word(body + END if ends else text, i)
            self.length[i] = len(body) if ends else len(text)
        self.automaton.make_automaton()
        self.specials = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.pieces = latin(pattern)
        library = self._library(path)
        self.normalise, self.split = library.normalizer.normalize_str, library.pre_tokenizer.pre_tokenize_str
        size = lambda key, ids: ENTRY + len(key) + len(ids)
        self.chunks = Remembered(self.chunk, lambda key, ids: 2 * size(key, ids))
        self.ids = Remembered(self.written, size)
        # a token may open a piece alone if its own letters are merged into it
        m = self.merges
        self.whole = {t for t, n in enumerate(self.length) if n and (m.rank[t] < 0 or m.builds(t))}

    @staticmethod
    def _library(path: str):
        from tokenizers import Tokenizer

        return Tokenizer.from_file(path)

    @cached_property
    def name(self) -> dict[str, str]:
        """The token of each id in decimal."""
        return {str(i): t for i, t in self.token.items()}

    def piece(self, letters: str) -> list[int]:
        """Ids of one piece in byte letters."""
        n, length, whole, fits = len(letters), self.length, self.whole, self.merges.known
        last: list[int] = [-1] * (n + 1)
        for end, token in self.automaton.iter(letters + END):
            at = end + 1 if end < n - 1 else n
            if last[at] >= 0 or end == n - 1:  # found, or the last letter without its mark
                continue
            start = at - length[token]
            if not start:
                if token in whole:
                    last[at] = token
            elif (before := last[start]) >= 0 and fits[before << 20 | token]:
                last[at] = token
        out, at = [], n
        while at:
            token = last[at]
            if token < 0:
                raise ValueError(f"no token ends at {at} of {letters!r}")
            out.append(token)
            at -= length[token]
        return out[::-1]

    def written(self, piece: str) -> str:
        """Decimal ids, joined by one space, of one lower-case piece."""
        plain = piece.isascii() and piece.isprintable()
        return " ".join(map(str, self.piece(piece if plain else "".join([self.letters[b] for b in piece.encode()]))))

    def chunk(self, chunk: str) -> str:
        """Decimal ids, joined by one space, of text without white space."""
        ids: list[str] = []
        for part in self.specials.split(chunk) if "<|" in chunk else (chunk,):
            if part in self.special:
                ids.append(str(self.special[part]))
            elif FOREIGN.search(part):  # classes of letters differ between versions of Unicode: as the library's rules split them
                ids += [" ".join(map(str, self.piece(x))) for x, _ in self.split(self.normalise(part))]
            else:
                ids += map(self.ids.__getitem__, self.pieces.findall(part.lower()))
        return " ".join(ids)

    def forget(self) -> None:
        """Give back what was remembered."""
        for table in (self.chunks, self.ids, self.merges.known):
            table.forget()

    def encode(self, text: str) -> Iterator[str]:
        """Decimal ids joined by one space, in slices of the text; slices without ids are left out."""
        for part in slices(text):
            if not UNUSUAL.search(part) and "<|" not in part:
                found = map(self.ids.__getitem__, self.pieces.findall(part.lower()))
            else:
                found = filter(None, map(self.chunks.__getitem__, WHITE.split(part)))
            if joined := " ".join(found):
                yield joined


class Remembered(dict):
    """What make(key) gave, made when first asked for. What was not asked for lately is let go of.

    A generation of REMEMBERED bytes, as `size` counts them, becomes the old one when it is full, and the old one goes; what
    is asked for again comes back from the old generation.
    """

    def __init__(self, make: Callable, size: Callable):
        super().__init__()
        self.make, self.size, self.held, self.old = make, size, 0, {}

    def __missing__(self, key):
        known = self.old.get(key)
        if known is None:
            known = self.make(key)
        more = self.size(key, known)
        self.held += more
        if self.held > REMEMBERED:
            self.old, self.held = dict(self), more
            self.clear()
        self[key] = known
        return known

    def forget(self) -> None:
        self.clear()
        self.old, self.held = {}, 0


def slices(text: str) -> Iterator[str]:
    """The text in parts that end before white space, a very long word whole."""
    start = 0
    while start < len(text):
        if len(text) - start <= SLICE:
            yield text[start:]
            return
        cut = WHITE.search(text, start + SLICE)
        end = cut.start() if cut else len(text)
        yield text[start:end]
        start = end


@lru_cache(1)
def _vocabulary(path: str) -> WordBpe:
    return WordBpe(path)


def vocabulary(path: str) -> WordBpe:
    """The vocabulary and its tables, which stay with the worker while this operator's tasks follow each other."""
    hold("bpe", _vocabulary.cache_clear)
    return _vocabulary(path)


def handed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Parts of some HANDED characters, null texts empty, so that the ids of a whole batch are never held."""
    for pdf in batches:
        pdf["text"] = pdf["text"].fillna("")
        group = (pdf["text"].str.len().cumsum() // HANDED).to_numpy()
        cuts = [0, *(np.flatnonzero(group[1:] != group[:-1]) + 1), len(pdf)]
        for a, b in zip(cuts, cuts[1:]):
            if b > a:
                yield pdf.iloc[a:b]


def encode_documents(df: DataFrame, path: str, text: str = "text", key: str = "doc_id", digests: bool = False) -> DataFrame:
    """One row per row of df: key, n_tokens and ids (array), or ids_sha256 and decoded_sha256 with `digests`.

    A null or blank text has no ids and decodes to nothing. Texts of any length are worked
    on in slices; a null key is carried through; other columns are not looked at.
    `path` names the vocabulary file, which every executor must be able to read.
    """
    ship(df.sparkSession)
    rows = df.select(as_key(key), F.col(f"`{text}`").alias("text"))

    def full(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = vocabulary(path)
        for pdf in handed(batches):
            ids = [np.concatenate([np.zeros(0, np.int32), *[np.fromstring(x, np.int32, sep=" ") for x in bpe.encode(t)]]) for t in pdf["text"]]
            yield pd.DataFrame({"key": pdf["key"].array, "n_tokens": [len(x) for x in ids], "ids": ids})

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = vocabulary(path)
        name = bpe.name.__getitem__
        for pdf in handed(batches):
            out = []
            for t in pdf["text"]:
                ids_hash, text_hash, n = hashlib.sha256(), hashlib.sha256(), 0
                for part in bpe.encode(t):
                    ids = part.split(" ")
                    space = b" " if n else b""
                    n += len(ids)
                    ids_hash.update(space + part.encode())
                    text_hash.update(space + " ".join(map(name, ids)).encode())
                out.append((n, ids_hash.hexdigest(), text_hash.hexdigest()))
            n, a, b = zip(*out)
            yield pd.DataFrame({"key": pdf["key"].array, "n_tokens": n, "ids_sha256": a, "decoded_sha256": b})

    if digests:
        made = rows.mapInPandas(hashed, "key string, n_tokens long, ids_sha256 string, decoded_sha256 string")
    else:
        made = rows.mapInPandas(full, "key string, n_tokens long, ids array<int>")
    return with_key(made, df, key)


def decode_documents(df: DataFrame, path: str, ids: str = "ids", key: str = "doc_id") -> DataFrame:
    """key and decoded: the tokens of each row's ids, joined by one space; unknown ids are left out.

    Null ids decode to nothing, as an empty array does.
    """
    ship(df.sparkSession)

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        token = vocabulary(path).token
        for pdf in batches:
            yield pd.DataFrame({"key": pdf["key"], "decoded": [" ".join([token[i] for i in x if i in token]) if x is not None else "" for x in pdf["ids"]]})

    rows = df.select(as_key(key), F.col(f"`{ids}`").alias("ids"))
    return with_key(rows.mapInPandas(decode, "key string, decoded string"), df, key)
