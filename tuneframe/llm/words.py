"""Words of UTF-8 texts as numpy arrays: offsets, 64-bit hashes and rolling hashes.

A word is a run of bytes outside space, tab, newline, vertical tab, form feed and
carriage return. All hashes are taken modulo 2**64 and finished by a mixing step.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from tuneframe.llm.ship import hold

SPACES = (9, 10, 11, 12, 13, 32)
#: Texts are worked on in groups of about this many bytes, which bounds the arrays.
PIECE_BYTES = 2 << 20

_rng = np.random.default_rng(20240229)
_BYTE_VALUES = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
IS_SPACE = np.zeros(256, bool)
IS_SPACE[list(SPACES)] = True
WORD_BASE, ROLL_BASE, SECOND_BASE = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 ... base**n modulo 2**64, kept for the next call unless large."""
    have = _powers.get(base)
    if have is None or len(have) <= n:
        size = max(n + 1, 1 << 16)
        have = np.full(size, base, np.uint64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        if size <= 4 << 20:
            _powers[base] = have
    return have[: n + 1]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _sums(values: np.ndarray, base: int) -> np.ndarray:
    n = len(values)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(values * powers(pow(base, -1, 1 << 64), n)[:n], out=sums[1:])
    return sums


def _segments(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """Polynomial hashes of values[start:end], from prefix sums."""
    sums = _sums(values, base)
    return (sums[ends] - sums[starts]) * powers(base, len(values))[starts]


def pieces(texts: list, limit: int = PIECE_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """Groups of encoded texts of about `limit` bytes, each with the number of texts before it."""
    hold("words", _powers.clear)
    group, size, first = [], 0, 0
    for i, text in enumerate(texts):
        data = text.encode("utf-8", "surrogatepass") if isinstance(text, str) else b""
        if group and size + len(data) > limit:
            yield first, group
            group, size, first = [], 0, i
        group.append(data)
        size += len(data)
    if group:
        yield first, group


class Words:
    """Words of several texts side by side.

    data: all bytes, a newline after each text. starts, ends: byte offsets of words.
    doc: the text of each word. first: index of each text's first word, and the total.
    """

    def __init__(self, group: list[bytes], lower: bool = False, space: np.ndarray = IS_SPACE):
        joined = b"\n".join(group) + b"\n"
        self.data = np.frombuffer(joined.lower() if lower else joined, np.uint8)
        space = space[self.data]
        change = np.flatnonzero(space[1:] != space[:-1]) + 1
        if not space[0]:
            change = np.concatenate([[0], change])
        self.starts, self.ends = change[0::2], change[1::2]
        if len(self.starts) > len(self.ends):  # a trailing run of spaces
            self.starts = self.starts[: len(self.ends)]
        self.text_starts = np.zeros(len(group) + 1, np.int64)
        np.cumsum([len(x) + 1 for x in group], out=self.text_starts[1:])
        self.first = np.searchsorted(self.starts, self.text_starts)
        self.counts = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(group)), self.counts)
        self._hashes = None

    @property
    def hashes(self) -> np.ndarray:
        if self._hashes is None:
            out, i, n, span = np.empty(len(self.starts), np.uint64), 0, len(self.starts), 1 << 18
            while i < n:  # cut at word ends, so that the arrays of 8 bytes a byte stay small
                j = max(i + 1, int(np.searchsorted(self.ends, self.starts[i] + span, "right")))
                low, high = int(self.starts[i]), int(self.ends[j - 1])
                raw = _segments(_BYTE_VALUES[self.data[low:high]], self.starts[i:j] - low, self.ends[i:j] - low, WORD_BASE)
                out[i:j] = mix(raw ^ (self.ends[i:j] - self.starts[i:j]).astype(np.uint64))
                i = j
            self._hashes = out
        return self._hashes

    def beginnings(self, sizes: tuple[int, ...]) -> list[np.ndarray]:
        """For each size the hashes of the words' first so many bytes, 0 for shorter words."""
        out, i, n, span = [np.zeros(len(self.starts), np.uint64) for _ in sizes], 0, len(self.starts), 1 << 18
        while i < n:
            j = max(i + 1, int(np.searchsorted(self.ends, self.starts[i] + span, "right")))
            low, high = int(self.starts[i]), int(self.ends[j - 1])
            starts, ends = self.starts[i:j] - low, self.ends[i:j] - low
            sums = _sums(_BYTE_VALUES[self.data[low:high]], WORD_BASE)
            scale = powers(WORD_BASE, high - low)[starts]
            for found, size in zip(out, sizes):
                stop = np.minimum(starts + size, ends)
                found[i:j] = np.where(ends - starts >= size, mix((sums[stop] - sums[starts]) * scale ^ np.uint64(size)), np.uint64(0))
            i = j
        return out

    def windows(self, k: int, base: int = ROLL_BASE) -> tuple[np.ndarray, np.ndarray]:
        """First word and hash of every run of k words inside one text."""
        n = len(self.starts) - k + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        at = np.flatnonzero(self.doc[: n] == self.doc[k - 1 :])
        return at, mix(_segments(self.hashes, at, at + k, base))


def member(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which values are in the sorted array `known`."""
    if not len(known):
        return np.zeros(len(values), bool)
    at = np.searchsorted(known, values)
    return known[np.minimum(at, len(known) - 1)] == values
