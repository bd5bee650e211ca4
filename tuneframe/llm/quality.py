"""Quality rules: counts that a document must keep to, and its divergence from its language.

Histograms of character classes and of common words are compared with the mean histograms
of all documents of the same language by Jensen-Shannon distance (base 2, 0 to 1). The
verdict is only given where document and language are long enough to be measured.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tuneframe.llm.ship import as_key, ship, with_key
from tuneframe.llm.words import Words, pieces
from tuneframe.session import settle

SPACE = " \t\n\v\f\r"
SYMBOLS = b"#*$%&|<>"
#: Frequent words of four languages.
COMMON = {
    "en": "the of and to in is that it for was on are as with be by at from or this an have not you which",
    "de": "der die und das den von zu mit sich ist ein eine nicht im für auf dem des auch es an werden aus er hat",
    "fr": "le la les de des et à un une que est en pour dans qui au pas sur du il ne se par plus avec ce",
    "es": "el la de que y en los del se las por un para con una su es al lo como más pero sus le ya o",
}
CLASSES = ("lower", "upper", "digit", "blank", "newline", "stop", "symbol", "two_byte", "more_byte")


def _classes() -> np.ndarray:
    kind = np.full(256, CLASSES.index("symbol"), np.uint8)
    for name, chars in (("lower", b"abcdefghijklmnopqrstuvwxyz"), ("upper", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"), ("digit", b"0123456789"), ("blank", b" \t\v\f\r"), ("newline", b"\n"), ("stop", b".,;:!?'\"()-")):
        kind[list(chars)] = CLASSES.index(name)
    kind[0x80:0xC0] = 255  # inside a character
    kind[0xC0:0xE0] = CLASSES.index("two_byte")
    kind[0xE0:] = CLASSES.index("more_byte")
    return kind


CLASS_OF = _classes()
IS_SYMBOL = np.zeros(256, np.int8)
IS_SYMBOL[list(SYMBOLS)] = 1


def common_words() -> list[str]:
    return sorted({w for words in COMMON.values() for w in words.split()})


def _spellings() -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of the common words, plain and with a capital, and the word each stands for."""
    words = common_words()
    made = [(spelling, i) for i, w in enumerate(words) for spelling in {w, w.capitalize()}]
    hashes = Words([" ".join(s for s, _ in made).encode()]).hashes
    order = np.argsort(hashes)
    return hashes[order], np.array([i for _, i in made])[order]


def repeat_words(w: Words) -> np.ndarray:
    """Words of each text that lie in 3-word windows found twice or more in it."""
    at, keys = w.windows(3)
    order = np.lexsort((keys, w.doc[at])) if len(at) else at
    doc, keys = w.doc[at][order], keys[order]
    same = (keys[1:] == keys[:-1]) & (doc[1:] == doc[:-1])
    twice = np.zeros(len(keys), bool)
    twice[1:] = same
    twice[:-1] |= same
    steps = np.zeros(len(w.starts) + 1, np.int64)
    np.add.at(steps, at[order][twice], 1)
    np.add.at(steps, at[order][twice] + 3, -1)
    return np.diff(np.concatenate([[0], np.cumsum(np.cumsum(steps[:-1]) > 0)])[w.first])


def duplicate_lines(text: str) -> int:
    lines = [x for x in text.split("\n") if x.strip(SPACE)]
    return len(lines) - len(set(lines))


def measure(texts: list) -> pd.DataFrame:
    """The counts and histograms of each text; a null text has none."""
    hashes, meaning = _spellings()
    n_common, out = len(common_words()), []
    for first, group in pieces(texts):
        w = Words(group)
        kind = CLASS_OF[w.data]
        cuts = w.text_starts[:-1]
        classes = np.stack([np.add.reduceat((kind == c).view(np.int8), cuts, dtype=np.int64) for c in range(len(CLASSES))], axis=1)
        blank = classes[:, CLASSES.index("blank")].copy()
        newline = classes[:, CLASSES.index("newline")]
        newline -= 1  # the one that ends each text here
        at = np.minimum(np.searchsorted(hashes, w.hashes), len(hashes) - 1)
        known = np.where(hashes[at] == w.hashes, meaning[at], n_common)
        words = np.bincount(w.doc * (n_common + 1) + known, minlength=len(group) * (n_common + 1)).reshape(len(group), -1)
        chars = classes.sum(axis=1)
        out.append(
            pd.DataFrame(
                {
                    "n_words": w.counts,
                    "word_chars": chars - blank - newline,
                    "n_symbols": np.add.reduceat(IS_SYMBOL[w.data], cuts, dtype=np.int64),
                    "n_dup_lines": [duplicate_lines(t) if isinstance(t, str) else 0 for t in texts[first : first + len(group)]],
                    "n_repeat_words": repeat_words(w),
                    "classes": list(classes.astype(float)),
                    "words": list(words.astype(float)),
                }
            )
        )
    return pd.concat(out) if out else pd.DataFrame(columns=["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "classes", "words"])


def js_distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two arrays of shares."""
    part = lambda a, m: F.when(a > 0, a * F.log2(a / m)).otherwise(0.0)
    terms = F.zip_with(p, q, lambda a, b: part(a, (a + b) / 2) + part(b, (a + b) / 2))
    return F.sqrt(F.greatest(F.lit(0.0), F.aggregate(terms, F.lit(0.0), lambda x, y: x + y) / 2))


def measured(df: DataFrame, text: str, key: str, language: str | None) -> DataFrame:
    ship(df.sparkSession)
    group = F.coalesce(F.col(f"`{language}`").cast("string"), F.lit("")) if language else F.lit("")
    rows = df.select(as_key(key), group.alias("language"), F.col(f"`{text}`").alias("text"))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            made = measure(pdf["text"].tolist())
            made.insert(0, "language", pdf["language"].to_numpy())
            made.insert(0, "key", pdf["key"].to_numpy())
            yield made

    counts = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
    return rows.mapInPandas(count, f"key string, language string, {counts}, classes array<double>, words array<double>")


def shares(counts: str) -> Column:
    return F.transform(counts, lambda x: x / F.greatest(F.lit(1.0), F.aggregate(counts, F.lit(0.0), lambda a, b: a + b)))


def quality_rules(
    df: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    language: str | None = "lang",
    class_limit: float = 0.28,
    word_limit: float = 0.75,
    min_words: int = 50,
    min_word_words: int = 150,
    min_reach: float = 0.2,
    min_language_words: int = 20_000,
) -> DataFrame:
    """One row per row of df: key, counts, base_failed, the two distances, and kept.

    base_failed: fewer than 50 words, or over half of them in repeated 3-word windows.
    kept is false if base_failed, or if a distance to the language passes its limit, in a
    document of min_words or more and a language of min_language_words or more. word_limit is
    a share of the distance from the language to a text with none of its common words; it
    binds in documents of min_word_words or more, as shorter ordinary texts may hold few of
    them, and where that distance is min_reach or more: other languages have no common words
    here. A null or blank text has no words and fails. A null language is a language of its own.
    """
    rows = settle(measured(df, text, key, language).withColumns({"p": shares("classes"), "q": shares("words")}).drop("classes", "words"))
    n_classes, n_words = len(CLASSES), len(common_words()) + 1
    mean = lambda c, n: F.array(*[F.avg(F.get(c, F.lit(i))) for i in range(n)])
    long = rows.filter(F.col("n_words") >= min_words)
    reference = long.groupBy("language").agg(F.sum("n_words").alias("language_words"), mean("p", n_classes).alias("p_mean"), mean("q", n_words).alias("q_mean"))
    none = F.array(*[F.lit(0.0)] * (n_words - 1), F.lit(1.0))
    judged = rows.join(reference.withColumn("reach", js_distance(none, F.col("q_mean"))), "language", "left")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    able = (F.col("n_words") >= min_words) & (F.coalesce("language_words", F.lit(0)) >= min_language_words)
    judged = judged.select(
        "key", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
        F.when(able, js_distance(F.col("p"), F.col("p_mean"))).alias("class_distance"),
        F.when(able, js_distance(F.col("q"), F.col("q_mean"))).alias("word_distance"),
        "reach",
    )
    far_words = (F.col("n_words") >= min_word_words) & (F.col("reach") >= min_reach) & (F.col("word_distance") > word_limit * F.col("reach"))
    far = F.coalesce(F.col("class_distance") > class_limit, F.lit(False)) | F.coalesce(far_words, F.lit(False))
    return with_key(judged.withColumn("kept", ~F.col("base_failed") & ~far).drop("reach"), df, key)
