"""Personal data, also in disguise: texts are normalised with a map back to their characters.

Plain detectors find e-mail addresses, IPv4 addresses, card numbers and phone numbers. A
transducer then rewrites what hides such data (look-alike letters, digits of other
scripts, invisible characters, spelled digits, "at" and "dot" in words or brackets, in
English, German, French and Spanish) and keeps, for every piece it writes, the piece it read. What the detectors find in the
normalised text beyond the plain finds is carried back to source offsets and added.

A disguise has gaps of up to three characters between its parts. Words for "dot" that are
ordinary words ("point", "Punkt", "punto") count inside an address or between digits only.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tuneframe.llm.ship import as_key, ship, with_key

KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, int, int]  # start, kind, end

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
#: Only the first digit of a run can begin an address: from a later one the same dot is missing.
IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
DIGIT = re.compile("[0-9]")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches in time that grows with the text: each @ is tried once, from where its run begins."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        found = EMAIL.match(text, start) if start < at else None
        if found:
            end = found.end()
            yield start, end
        at = text.find("@", end if found else at + 1)


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def plain_spans(text: str) -> list[Span]:
    """What the four detectors find, in order of start and kind."""
    out: list[Span] = []
    if "@" in text:
        out += [(a, 0, b) for a, b in emails(text)]
    if DIGIT.search(text):
        for m in IP.finditer(text):
            if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or "0") <= 255 for part in m[0].split(".")):
                out.append((m.start(), 1, m.end()))
        for m in CARD.finditer(text):
            if m.end() - m.start() >= 14:
                digits = m[0].replace(" ", "").replace("-", "")
                if 14 <= len(digits) <= 19 and luhn(digits):
                    out.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 10 <= sum(map(str.isdigit, m[0])) <= 15:
                    out.append((m.start(), 3, m.end()))
    return sorted(out)


#: Letters of other alphabets that look like Latin ones.
LOOKALIKES = dict(
    zip(
        "аеорсухіѕјһԁԛԝɡӏАВЕКМНОРСТУХІЅЈαορνικυτΑΒΕΖΗΙΚΜΝΟΡΤΥΧ",
        "aeopcyxisjhdqwglABEKMHOPCTYXISJaopvikutABEZHIKMNOPTYX",
    )
)
MARKS = {"﹫": "@", "․": ".", "。": ".", "。": ".", "‐": "-", "‑": "-", "‒": "-", "–": "-", "—": "-", "−": "-", " ": " "}
INVISIBLE = "​‌‍⁠﻿­"
#: The words for the digits 0 to 9 in English, German, French and Spanish, with what is said for them on the phone.
SPELLED = [
    "zero oh null zéro cero",
    "one eins un une uno",
    "two zwei zwo deux dos",
    "three drei trois tres",
    "four vier quatre cuatro",
    "five fünf fuenf cinq cinco",
    "six sechs seis",
    "seven sieben sept siete",
    "eight acht huit ocho",
    "nine neun neuf nueve",
]
NUMBERS = {word: str(digit) for digit, words in enumerate(SPELLED) for word in words.split()}
TIMES = {"double": 2, "triple": 3, "doppel": 2, "doble": 2}


def _letters() -> dict[str, str]:
    """Each disguised character and the ASCII character it stands for."""
    table = dict(LOOKALIKES)
    compatible = [*range(0x2100, 0x2150), *range(0x2460, 0x2500), *range(0xFF01, 0xFF5F), *range(0x1D400, 0x1D800)]
    for code in compatible:
        plain = unicodedata.normalize("NFKC", chr(code))
        if len(plain) == 1 and plain.isascii() and plain.isprintable():
            table[chr(code)] = plain
    for code in range(0x80, 0x1FBFA):
        if unicodedata.category(chr(code)) == "Nd":
            table[chr(code)] = str(unicodedata.decimal(chr(code)))
    return table


#: One character for one, so that translating keeps all offsets.
TABLE = str.maketrans(_letters() | MARKS)
_NUMBER = "(?:" + "|".join(NUMBERS) + ")"
_OPEN, _CLOSE = r"[\[({<]\s{0,3}", r"\s{0,3}[\])}>]"
_ACCENTED = "(?:" + "|".join(word for word in NUMBERS if not word.isascii()) + ")"
_TIMES = "(?:" + "|".join(TIMES) + ")"
_COUNTED = rf"(?:{_TIMES}\s{{1,3}})?{_NUMBER}"
_POINT = "(?:punkt|punto|point)"
_AROUND = "(?:arroba|arobase|arrobase|klammeraffe|ät)"
_HIDDEN_DOT = rf"\s{{0,3}}{_OPEN}(?:dot|{_POINT}|\.){_CLOSE}\s{{0,3}}"
_DOT = rf"(?:{_HIDDEN_DOT}|\s{{1,3}}dot\s{{1,3}})"
_ANY_DOT = rf"(?:{_HIDDEN_DOT}|\s{{1,3}}(?:dot|{_POINT})\s{{1,3}})"
_ANY_AT = rf"(?:\s{{0,3}}{_OPEN}(?:at|@|{_AROUND}){_CLOSE}\s{{0,3}}|\s{{1,3}}{_AROUND}\s{{1,3}})"
_LABEL = "[A-Za-z0-9-]{1,63}"
_LOCAL = "[A-Za-z0-9_%+-][A-Za-z0-9._%+-]{0,63}"
#: An address whose sign or dots are words of other languages than English, which mean other things elsewhere.
_ADDRESS = (
    rf"(?<![\w.%+-]){_LOCAL}(?:{_ANY_DOT}{_LOCAL}){{0,4}}"
    rf"(?:{_ANY_AT}{_LABEL}(?:(?:\.|{_ANY_DOT}){_LABEL}){{1,8}}"
    rf"|@{_LABEL}\s{{1,3}}{_POINT}\s{{1,3}}{_LABEL}"
    rf"|\s{{1,3}}at\s{{1,3}}{_LABEL}(?:\s{{1,3}}(?:punkt|punto)\s{{1,3}}{_LABEL}){{1,8}})"
)
SIGN = re.compile(rf"{_ANY_AT}|\s{{1,3}}at\s{{1,3}}", re.IGNORECASE)
PLAIN_SIGN = re.compile("[A-Za-z0-9._%+-]@[A-Za-z0-9-]")
POINT = re.compile(_ANY_DOT, re.IGNORECASE)
#: What makes a lower-case text worth a second look. A spelled digit with no digit near it is in no identifier
#: but an address, which is found as it stands; what may part digits is what the detectors and REWRITE allow.
_GAP = r"[\s,().-]+"
LOOKS = [
    re.compile(pattern)
    for pattern in (
        rf"{_OPEN}(?:at|@|{_AROUND}|dot|{_POINT}|\.){_CLOSE}",
        rf"\s(?:dot|{_AROUND})\s",
        rf"@{_LABEL}\s{{1,3}}{_POINT}\s",
        rf"\sat\s{{1,3}}{_LABEL}\s{{1,3}}(?:punkt|punto)\s",
        rf"\s{_POINT}\s{{1,3}}(?:{_COUNTED}\b|[0-9])",
        rf"\b(?:plus|más)\s{{1,3}}(?:{_COUNTED}|[0-9])",
        rf"\b{_TIMES}\s{{1,3}}{_NUMBER}\b",
        rf"[.@-]{_ACCENTED}\b|\b{_ACCENTED}[.@_%+-]",
        rf"[0-9]{_GAP}{_NUMBER}\b",
        rf"\b{_NUMBER}\b{_GAP}(?:{_NUMBER}\b|[0-9])",
    )
]
HIDDEN = re.compile(f"[{INVISIBLE}]")
REWRITE = re.compile(
    "|".join(
        [
            rf"(?P<address>{_ADDRESS})",
            rf"(?P<at>\s{{0,3}}{_OPEN}(?:at|@){_CLOSE}\s{{0,3}})",
            rf"(?P<bare_at>(?<=[A-Za-z0-9_%+-])\s{{1,3}}at\s{{1,3}}(?!(?:the|an?|this|that|all|our|my|your)\s)(?=[A-Za-z0-9-]{{1,63}}{_DOT}[A-Za-z0-9-]))",
            rf"(?P<dot>(?<=[A-Za-z0-9-]){_DOT}(?=[A-Za-z0-9-]))",
            rf"(?P<point>(?<=[A-Za-z0-9])\s{{1,3}}{_POINT}\s{{1,3}}(?=(?:{_COUNTED}\b|[0-9])))",
            rf"(?P<plus>\b(?:plus|más)\s{{1,3}}(?=(?:{_COUNTED}|[0-9])\b))",
            rf"(?P<number>\b{_COUNTED}\b(?:[\s,-]{{1,3}}(?={_COUNTED}\b))?)",
            rf"(?P<gone>[{INVISIBLE}])",
        ]
    ),
    re.IGNORECASE,
)


def folded(text: str) -> str:
    """In lower case, with the letters that REWRITE takes for s and i whatever their case."""
    low = text.lower()
    return low if low.isascii() else low.replace("\u017f", "s").replace("\u0131", "i").replace("i\u0307", "i")


def suspicious(text: str, translated: str) -> bool:
    """Whether rewriting could change what is found: never false where it does."""
    if translated is not text and translated != text or not text.isascii() and HIDDEN.search(text):
        return True
    low = folded(translated)
    return any(look.search(low) for look in LOOKS)


def translate(text: str) -> str:
    if text.isascii():
        return text
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return text.translate(TABLE)
    return text.replace("\xa0", " ")


class Normalised:
    """A rewritten text and, for each of its pieces, the source piece."""

    def __init__(self, text: str):
        parts: list[str] = []
        self.starts, self.source, self.plain = [0], [(0, 0)], [True]
        self.length = at = 0
        for m in REWRITE.finditer(text):
            kind = m.lastgroup
            if kind == "number":
                *times, word = re.findall(r"[^\W\d_]+", folded(m[0]))
                new = NUMBERS[word] * (TIMES[times[0]] if times else 1)
            elif kind == "address":
                new = POINT.sub(".", m[0] if PLAIN_SIGN.search(m[0]) else SIGN.sub("@", m[0], 1))
            else:
                new = {"at": "@", "bare_at": "@", "dot": ".", "point": ".", "plus": "+", "gone": ""}[kind]
            self._add(parts, text[at : m.start()], at, m.start(), True)
            self._add(parts, new, m.start(), m.end(), False)
            at = m.end()
        self._add(parts, text[at:], at, len(text), True)
        self.text = "".join(parts)

    def _add(self, parts: list[str], new: str, start: int, end: int, plain: bool) -> None:
        if new:
            parts.append(new)
            self.starts.append(self.length)
            self.source.append((start, end))
            self.plain.append(plain)
            self.length += len(new)

    def back(self, start: int, end: int) -> tuple[int, int]:
        """Source offsets of a span of the new text."""
        first, last = bisect_right(self.starts, start) - 1, bisect_right(self.starts, end - 1) - 1
        low = self.source[first][0] + (start - self.starts[first] if self.plain[first] else 0)
        high = self.source[last][0] + end - self.starts[last] if self.plain[last] else self.source[last][1]
        return low, high


def trimmed(text: str, start: int, end: int) -> tuple[int, int]:
    """A source span without the white space that a rewriting took in at its ends."""
    while end > start and text[end - 1] in " \t\n\r,-":
        end -= 1
    while start < end and text[start].isspace():
        start += 1
    return start, end


def find(text: str) -> tuple[list[Span], list[Span]]:
    """The plain spans, and all spans: plain ones and those found in disguise."""
    base = plain_spans(text)
    translated = translate(text)
    if not suspicious(text, translated):
        return base, base
    new, known = Normalised(translated), set(base)
    for start, kind, end in plain_spans(new.text):
        made = new.text[start:end]
        start, end = trimmed(text, *new.back(start, end))
        if text[start:end] != made and not any(k == kind and a <= start and end <= b for a, k, b in base):
            known.add((start, kind, end))
    return base, sorted(known)


def named(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def redacted(text: str, spans: list[Span]) -> str:
    """The text with each span, or run of overlapping spans, as the name of its first kind in brackets."""
    out, at, i = [], 0, 0
    while i < len(spans):
        start, kind, end = spans[i]
        i += 1
        while i < len(spans) and spans[i][0] < end:
            end = max(end, spans[i][2])
            i += 1
        out += [text[at:start], f"[{KINDS[kind].upper()}]"]
        at = end
    return "".join(out) + text[at:]


def personal_data(df: DataFrame, text: str = "text", key: str = "doc_id", redact: bool = False) -> DataFrame:
    """One row per row of df: key, n_email, n_ip, n_card, n_phone (plain), n_disguised, base_sha256, spans.

    With `redact`, every column of df is kept and `text` holds the redacted text instead. A
    null text counts as empty and stays null. Offsets are code points, ends exclusive.
    """
    ship(df.sparkSession)
    if redact:
        kinds = df.schema
        rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns if c != text]).alias("rest"), F.col(f"`{text}`").alias("body"))
        # the other columns stay in the JVM's keeping as one string each would lose types; a Pandas UDF touches the text alone
        hide = F.pandas_udf(lambda s: s.map(lambda t: redacted(t, find(t)[1]) if isinstance(t, str) else None), "string")
        return rows.select("rest.*", hide("body").alias(text)).select(*kinds.names)
    rows = df.select(as_key(key), F.col(f"`{text}`").alias("text"))

    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for t in pdf["text"]:
                base, found = find(t or "")
                counts = [sum(k == i for _, k, _ in base) for i in range(len(KINDS))]
                out.append((*counts, len(found) - len(base), hashlib.sha256(named(base).encode()).hexdigest(), named(found)))
            made = pd.DataFrame(out, columns=["n_email", "n_ip", "n_card", "n_phone", "n_disguised", "base_sha256", "spans"])
            made.insert(0, "key", pdf["key"].to_numpy())
            yield made

    schema = "key string, n_email long, n_ip long, n_card long, n_phone long, n_disguised long, base_sha256 string, spans string"
    return with_key(rows.mapInPandas(look, schema), df, key)
