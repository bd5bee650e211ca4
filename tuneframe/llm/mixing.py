"""Mixing to target weights with soft membership.

A classifier learned from a labelled table gives each document posteriors over domains.
Projected gradient steps on the documents' rates solve a least squares: the sum over documents of rate * tokens *
posterior is to meet each domain's target. Every document begins at a rate of one, and each step
takes its posterior times one vector off its rate, which is cut at nought. So a step is a sum over
all documents in Spark and a vector of one number for each domain, and a rate is read off the
document's own posterior and the vectors of the steps. Texts are classified once.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import add

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tuneframe.llm.quality import CLASS_OF, CLASSES
from tuneframe.llm.samples import labelled_texts
from tuneframe.llm.ship import ship
from tuneframe.llm.toxicity import SLOTS, evidence, read
from tuneframe.llm.words import IS_SPACE, Words, pieces
from tuneframe.session import settle

#: Domains of the labels table and the shares of tokens they are to have.
TARGETS = {"good": 0.95, "poor": 0.03, "toxic": 0.02}
#: Bytes of the beginnings of words that give evidence beside the word itself.
BEGINNINGS = (5, 6, 7)
#: Words with more evidence than this are counted; chance gives less.
STRONG = 2.0


def label_domain() -> Column:
    return F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "good").when(F.col("quality") == 0, "poor")


@dataclass(frozen=True)
class Fit:
    """Bounds of the labelled sample (rows of each domain, in the order of a hash of the key) and of the steps."""

    per_domain: int = 1200
    max_chars: int = 20_000
    strength: float = 3.0
    steps: int = 40
    tolerance: float = 1e-7  # share of a target that its total may be off when the steps end


@dataclass
class Classifier:
    """Soft-max regression on character classes and on the evidence of words for each domain."""

    tables: np.ndarray  # domains, slots
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # inputs and a constant, domains

    def posteriors(self, group: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of each text, and its posterior."""
        n, x, _ = inputs(group, self.tables)
        x = np.hstack([(x - self.mean) / self.scale, np.ones((len(x), 1))])
        return n, softmax(x @ self.weights)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def inputs(group: list[bytes], tables: np.ndarray, own: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, object]:
    """Tokens of each text, and its inputs: shares of character classes, for each domain the most
    evidence of a word and the number of words with strong evidence, and the length. `own` replaces
    the evidence of the words, (words, domains)."""
    w = read(group)
    cuts = w.text_starts[:-1]
    kind = CLASS_OF[w.data]
    shares = np.stack([np.add.reduceat((kind == c).view(np.int8), cuts, dtype=np.int64) for c in range(len(CLASSES))], axis=1).astype(float)
    upper = np.add.reduceat(np.concatenate([_upper(g) for g in group]), cuts, dtype=np.int64)
    shares[:, CLASSES.index("upper")] = upper
    shares[:, CLASSES.index("lower")] -= upper
    shares /= np.maximum(1, shares.sum(axis=1, keepdims=True))
    space = IS_SPACE[w.data]
    begins = np.flatnonzero(space[:-1] & ~space[1:]) + 1
    tokens = np.diff(np.searchsorted(begins, w.text_starts))
    tokens[0] += ~space[0]  # each later text follows a newline
    found = np.zeros((len(group), 2 * len(tables)))
    full = np.flatnonzero(w.counts)
    if len(full):
        values = own if own is not None else np.stack([t[codes_of(w)].max(axis=1) for t in tables], axis=1)
        first = w.first[:-1][full]
        found[full] = np.hstack([np.maximum.reduceat(values, first, axis=0), np.log1p(np.add.reduceat(values > STRONG, first, axis=0, dtype=float))])
    return tokens.astype(np.int64), np.hstack([shares, found, np.log1p(tokens)[:, None]]), w


def _upper(data: bytes) -> np.ndarray:
    a = np.frombuffer(data + b"\n", np.uint8)
    return ((a >= 65) & (a <= 90)).view(np.int8)


def codes_of(w: Words) -> np.ndarray:
    """For each word a slot for itself and for each of its beginnings; slot 0 for none."""
    hashes = [w.hashes, *w.beginnings(BEGINNINGS)]
    return np.stack([np.where(h == 0, 0, 1 + (h >> np.uint64(20)) % np.uint64(SLOTS - 1)) for h in hashes], axis=1).astype(np.int64)


def learn(texts: list[str], domains: list[int], k: int, how: Fit) -> Classifier:
    """Fit to a sample; without rows of two domains at least, all domains are alike."""
    y = np.array(domains, int)
    n_inputs = len(CLASSES) + 2 * k + 1
    plain = Classifier(np.zeros((k, SLOTS), np.float32), np.zeros(n_inputs), np.ones(n_inputs), np.zeros((n_inputs + 1, k)))
    if len(set(domains)) < 2:
        return plain
    groups = [t.encode("utf-8", "surrogatepass") for t in texts]
    w = read(groups)
    codes = codes_of(w)
    pairs = np.unique(np.concatenate([np.unique(w.doc * np.int64(SLOTS) + codes[:, c]) for c in range(codes.shape[1])]))
    doc, slot = np.divmod(pairs, SLOTS)
    tables, own = [], []
    for d in range(k):
        mark = (y == d).astype(float)
        base = (mark.sum() + 1) / (len(y) + k)
        positive, negative = np.bincount(slot, mark[doc], SLOTS), np.bincount(slot, 1 - mark[doc], SLOTS)
        tables.append(evidence(positive, negative, base, how.strength))
        tables[-1][0] = 0
        mine, others = mark[w.doc], np.full(len(codes), -np.inf, np.float32)
        for c in codes.T:  # a document reads the evidence of the others; a column at a time keeps the driver small
            found = evidence(np.maximum(positive[c] - mine, 0), np.maximum(negative[c] - (1 - mine), 0), base, how.strength)
            np.maximum(others, np.where(c == 0, np.float32(0), found), out=others)
        own.append(others)
    _, x, _ = inputs(groups, np.array(tables), np.stack(own, axis=1))
    mean, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-6)
    x = np.hstack([(x - mean) / scale, np.ones((len(x), 1))])
    target, weights = np.eye(k)[y], np.zeros((x.shape[1], k))
    rate = 1.0 / (0.25 * np.linalg.norm(x, 2) ** 2 / len(x) * 2 + 1e-3)
    for _ in range(800):
        weights -= rate * (x.T @ (softmax(x @ weights) - target) / len(x) + 1e-4 * weights)
    return Classifier(np.array(tables), mean, scale, weights)


def sample(df: DataFrame, labels: DataFrame, text: str, key: str, domain: Column, names: list[str], how: Fit) -> list:
    """(index of the domain, text) of labelled rows; of two labels of a key the last by name counts."""
    marks = labels.select(F.col(key).alias("key"), domain.alias("label")).filter(F.col("label").isin(names)).groupBy("key").agg(F.max("label").alias("label"))
    rows = labelled_texts(df, marks, text, key, dict.fromkeys(names, how.per_domain), how.max_chars)
    return sorted((names.index(label), t) for label, t in rows)


def rate_of(posterior: list[Column], steps: list[list[float]]) -> Column:
    """The rate of a posterior after the steps, from a rate of one."""
    rate = F.lit(1.0)
    for step in steps:
        rate = F.greatest(F.lit(0.0), rate - reduce(add, [p * F.lit(float(x)) for p, x in zip(posterior, step)]))
    return rate


def solve(rows: DataFrame, wanted: list[float], how: Fit) -> list[list[float]]:
    """The steps to the rates of the least squares. rows: share (of all tokens), p0, p1, ... (posterior).

    A step goes down the gradient, posterior . (totals - wanted), scaled by the inverse of the
    curvature of the documents whose rate is above nought. If it would lead uphill it is shortened, and
    at last taken down the plain gradient at a length that cannot. Where no rates meet the targets
    the steps end when they gain next to nothing or are used up.
    """
    k, goal = len(wanted), np.array(wanted)
    p = [F.col(f"p{i}") for i in range(k)]

    def look(steps: list[list[float]]) -> tuple[np.ndarray, np.ndarray]:
        rated = rows.select("share", *p, rate_of(p, steps).alias("rate"))
        free = F.when(F.col("rate") > 0, F.col("share")).otherwise(0.0)
        sums = [F.sum(F.col("share") * F.col("rate") * x) for x in p] + [F.sum(free * p[i] * p[j]) for i in range(k) for j in range(i, k)]
        found = [float(x or 0.0) for x in rated.agg(*sums).first()]
        curve = np.zeros((k, k))
        curve[np.triu_indices(k)] = found[k:]
        return np.array(found[:k]), np.maximum(curve, curve.T)

    steps: list[list[float]] = []
    totals, curve = look(steps)
    plain = 1 / max(np.linalg.norm(curve, 2), 1e-300)
    while len(steps) < how.steps:
        off = totals - goal
        if (np.abs(off) <= how.tolerance * goal).all():
            break
        newton = np.linalg.pinv(curve, rcond=1e-12, hermitian=True) @ off
        for step in (*[newton / 4**j for j in range(6)], plain * off):
            after, bend = look([*steps, step.tolist()])
            if np.linalg.norm(after - goal) < (1 - 1e-4) * np.linalg.norm(off):
                break
        else:
            break
        steps.append(step.tolist())
        totals, curve = after, bend
    return steps


def mixture(
    df: DataFrame, labels: DataFrame, targets: dict[str, float] = TARGETS, text: str = "text", key: str = "doc_id", budget: float = 1.0, domain: Column | None = None, how: Fit = Fit(),
    carry: Sequence[str] | None = None,
) -> DataFrame:
    """One row per row of df: row (df's columns, or those to carry), n_tokens, posterior (of the targets in order), rate, copies.

    The rates' expected tokens are budget times the tokens of df. copies is rate rounded up
    or down by a hash of key and text, so that its mean is the rate. A null or blank text has
    no tokens, the posterior of an empty text and its rate. With labels of fewer than two
    domains every domain is as likely. Columns of df keep their names inside `row`. What is
    carried is written to the shared folder once, beside the posteriors.
    """
    ship(df.sparkSession)
    names = list(targets)
    learned = sample(df, labels, text, key, label_domain() if domain is None else domain, names, how)
    shared = df.sparkSession.sparkContext.broadcast(learn([t for _, t in learned], [d for d, _ in learned], len(names), how))  # a few MB
    columns = [f"p{i}" for i in range(len(names))]

    @F.pandas_udf("n_tokens long, " + ", ".join(f"{c} double" for c in columns))
    def classify(texts: pd.Series) -> pd.DataFrame:
        parts = [shared.value.posteriors(group) for _, group in pieces(texts.tolist())]
        n = np.concatenate([a for a, _ in parts]) if parts else np.zeros(0, int)
        p = np.vstack([p for _, p in parts]) if parts else np.zeros((0, len(columns)))
        return pd.DataFrame({"n_tokens": n, **dict(zip(columns, p.T))})

    chance = F.pmod(F.xxhash64(f"`{key}`", f"`{text}`"), F.lit(1 << 20)) / float(1 << 20)
    row = F.struct(*[F.col(f"`{c}`") for c in (df.columns if carry is None else carry)])
    judged = settle(df.select(row.alias("row"), chance.alias("chance"), classify(F.col(f"`{text}`")).alias("m")).select("row", "chance", "m.*"))
    total = float(judged.agg(F.sum("n_tokens")).first()[0] or 1)
    rows = judged.filter("n_tokens > 0").select((F.col("n_tokens") / total).alias("share"), *columns)
    steps = solve(rows, [budget * targets[d] for d in names], how)
    made = judged.withColumn("rate", rate_of([F.col(c) for c in columns], steps))
    return made.select("row", "n_tokens", F.array(*columns).alias("posterior"), "rate", F.floor(F.col("rate") + F.col("chance")).cast("int").alias("copies"))


def mixed(df: DataFrame, labels: DataFrame, targets: dict[str, float] = TARGETS, **more) -> DataFrame:
    """df with each row as many times as its copies, and its columns only."""
    made = mixture(df, labels, targets, **more).filter("copies > 0")
    return made.withColumn("copy", F.explode(F.sequence(F.lit(1), "copies"))).select("row.*")
