"""Toxicity: a bidirectional gated recurrent network over words and their characters.

Each word is read as the evidence that the word itself and its beginnings of several
lengths (the character inputs) give for the label, learned from the training rows. Two
recurrent passes, attention over their states and a linear layer score a window of words;
a document's score is that of its highest window, over all overlapping windows. Training
is multiple-instance: for each document, the window that scores highest is learned from.

The network is trained in numpy on the driver, on a sample of labelled rows bounded by
`Training`; all documents are scored in Spark tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tuneframe.llm.samples import labelled_texts
from tuneframe.llm.ship import as_key, ship, with_key
from tuneframe.llm.words import Words, pieces

WINDOW, STRIDE = 64, 48
BEGINNINGS = (3, 4, 5, 6, 7, 8)
N_INPUTS = 1 + len(BEGINNINGS)
SLOTS = 1 << 17
HIDDEN, ATTENTION = 8, 8
#: Only letters, digits and characters beyond ASCII make words here.
SPACE = np.ones(256, bool)
SPACE[0x80:] = False
SPACE[list(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789")] = False


@dataclass(frozen=True)
class Training:
    """Bounds of the labelled sample (rows of either label, in the order of a hash of the key) and the fit."""

    positives: int = 800
    negatives: int = 2400
    max_chars: int = 20_000
    epochs: int = 14
    batch: int = 64
    rate: float = 0.02
    strength: float = 3.0  # of the prior in the evidence of a word


def held_out(key: Column, folds: int = 3, fold: int = 1) -> Column:
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % folds == fold, F.lit(False))


def slots(w: Words) -> np.ndarray:
    """For each word a slot for itself and for each of its beginnings; slot 0 for none."""
    hashes = [w.hashes, *w.beginnings(BEGINNINGS)]
    columns = [np.where(h == 0, 0, 1 + (h >> np.uint64(20)) % np.uint64(SLOTS - 1)) for h in hashes]
    return np.stack(columns, axis=1).astype(np.int64) + np.arange(N_INPUTS) * SLOTS


def read(group: list[bytes]) -> Words:
    return Words(group, lower=True, space=SPACE)


def window_starts(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """First word and text of every window; the last window of a text ends with it."""
    starts, docs = [], []
    for d in np.flatnonzero(w.counts):
        n = int(w.counts[d])
        s = np.arange(0, max(1, n - WINDOW + STRIDE), STRIDE)
        s = np.minimum(s, max(0, n - WINDOW))
        starts.append(s + w.first[d])
        docs.append(np.full(len(s), d))
    if not starts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(starts), np.concatenate(docs)


def gather(inputs: np.ndarray, w: Words, starts: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(time, window, inputs) and the mask of words inside the text."""
    at = starts[None, :] + np.arange(WINDOW)[:, None]
    mask = at < w.first[docs + 1][None, :]
    x = inputs[np.minimum(at, len(inputs) - 1)]
    if not mask.all():
        x = x * mask[:, :, None]
    return x, mask.astype(np.float32)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


def new_parameters(rng: np.random.Generator) -> dict[str, np.ndarray]:
    draw = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
    p = {}
    for side in "fb":
        p |= {f"w{side}": draw(N_INPUTS, 3 * HIDDEN), f"u{side}": draw(HIDDEN, 3 * HIDDEN), f"b{side}": np.zeros(3 * HIDDEN, np.float32)}
    return p | {"a": draw(2 * HIDDEN, ATTENTION), "c": np.zeros(ATTENTION, np.float32), "v": draw(ATTENTION), "o": draw(2 * HIDDEN), "d": np.zeros(1, np.float32)}


def recur(p: dict, side: str, x: np.ndarray, mask: np.ndarray, trace: list | None = None) -> np.ndarray:
    """States of one direction, (time, window, hidden)."""
    steps, n, _ = x.shape
    pre = x @ p[f"w{side}"] + p[f"b{side}"]
    u, h = p[f"u{side}"], np.zeros((n, HIDDEN), np.float32)
    out = np.empty((steps, n, HIDDEN), np.float32)
    full = bool(mask.all())
    for t in range(steps) if side == "f" else range(steps - 1, -1, -1):
        hu = h @ u
        gates = sigmoid(pre[t, :, : 2 * HIDDEN] + hu[:, : 2 * HIDDEN])
        z, r = gates[:, :HIDDEN], gates[:, HIDDEN:]
        new = np.tanh(pre[t, :, 2 * HIDDEN :] + r * hu[:, 2 * HIDDEN :])
        if trace is not None:
            trace.append((t, h, z, r, new, hu[:, 2 * HIDDEN :]))
        step = new + z * (h - new)
        h = step if full else h + mask[t][:, None] * (step - h)
        out[t] = h
    return out


def forward(p: dict, x: np.ndarray, mask: np.ndarray, keep: dict | None = None) -> np.ndarray:
    """The logit of each window."""
    traces = {s: [] if keep is not None else None for s in "fb"}
    h = np.concatenate([recur(p, s, x, mask, traces[s]) for s in "fb"], axis=2)
    energy = np.tanh(h @ p["a"] + p["c"])
    e = energy @ p["v"] + (mask - 1) * 1e4
    e = np.exp(e - e.max(axis=0))
    share = e / e.sum(axis=0)
    pooled = np.einsum("tn,tnh->nh", share, h)
    if keep is not None:
        keep.update(traces=traces, h=h, energy=energy, share=share, pooled=pooled)
    return pooled @ p["o"] + p["d"][0]


def gradients(p: dict, x: np.ndarray, mask: np.ndarray, target: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
    """Of the weighted cross entropy."""
    k: dict = {}
    logit = forward(p, x, mask, k)
    dl = ((sigmoid(logit) - target) * weight / len(target)).astype(np.float32)
    h, share, energy = k["h"], k["share"], k["energy"]
    g = {"o": k["pooled"].T @ dl, "d": np.array([dl.sum()], np.float32)}
    dpool = dl[:, None] * p["o"]
    dh = share[:, :, None] * dpool
    dshare = np.einsum("tnh,nh->tn", h, dpool)
    de = share * (dshare - (share * dshare).sum(axis=0))
    g["v"] = np.einsum("tn,tna->a", de, energy)
    dlin = de[:, :, None] * p["v"] * (1 - energy**2)
    g["a"], g["c"] = np.einsum("tnh,tna->ha", h, dlin), dlin.sum(axis=(0, 1))
    dh = dh + dlin @ p["a"].T
    for i, side in enumerate("fb"):
        own = dh[:, :, i * HIDDEN : (i + 1) * HIDDEN]
        gw, gu, gb = np.zeros_like(p[f"w{side}"]), np.zeros_like(p[f"u{side}"]), np.zeros_like(p[f"b{side}"])
        carry, u = np.zeros((x.shape[1], HIDDEN), np.float32), p[f"u{side}"]
        for t, before, z, r, new, hun in reversed(k["traces"][side]):
            dnext = (own[t] + carry) * mask[t][:, None]
            carry = (own[t] + carry) * (1 - mask[t][:, None])
            dnew = dnext * (1 - z) * (1 - new**2)
            dz = dnext * (before - new) * z * (1 - z)
            dr = dnew * hun * r * (1 - r)
            dpre = np.concatenate([dz, dr, dnew], axis=1)
            dhu = np.concatenate([dz, dr, dnew * r], axis=1)
            gw += x[t].T @ dpre
            gb += dpre.sum(axis=0)
            gu += before.T @ dhu
            carry = carry + dnext * z + dhu @ u.T
        g[f"w{side}"], g[f"u{side}"], g[f"b{side}"] = gw, gu, gb
    return g


def evidence(positive: np.ndarray, negative: np.ndarray, base: float, strength: float) -> np.ndarray:
    """Log odds of label 1 with a feature, above those without one, drawn to none where it is rare."""
    share = (positive + strength * base) / (positive + negative + strength)
    return np.clip(np.log(share / (1 - share)) - np.log(base / (1 - base)), -4, 4).astype(np.float32)


@dataclass
class Network:
    parameters: dict[str, np.ndarray]
    table: np.ndarray

    def logits(self, group: list[bytes]) -> np.ndarray:
        """The highest window's logit of each text; one without words gets that of nothing read."""
        w = read(group)
        out = np.full(len(group), float(self.parameters["d"][0]))
        if not len(w.starts):
            return out
        inputs = self.table[slots(w)]
        starts, docs = window_starts(w)
        best = np.full(len(group), -np.inf)
        for a in range(0, len(starts), 2048):
            x, mask = gather(inputs, w, starts[a : a + 2048], docs[a : a + 2048])
            np.maximum.at(best, docs[a : a + 2048], forward(self.parameters, x, mask))
        return np.where(w.counts > 0, best, out)


def train(texts: list[str], labels: list[int], how: Training = Training(), seed: int = 7) -> Network:
    """Fit a network; labels of one kind only give a network that always tells their rate."""
    y = np.array(labels, np.float32)
    rng = np.random.default_rng(seed)
    p = new_parameters(rng)
    base = float((y.sum() + 1) / (len(y) + 4))
    table = np.zeros(N_INPUTS * SLOTS, np.float32)
    if not len(y) or y.min() == y.max():
        p["o"][:] = 0
        p["d"][:] = np.log(base / (1 - base))
        return Network(p, table)
    groups = [t.encode("utf-8", "surrogatepass") for t in texts]
    w = read(groups)
    codes = slots(w)
    positive, negative = np.zeros(N_INPUTS * SLOTS), np.zeros(N_INPUTS * SLOTS)
    inputs = np.empty(codes.shape, np.float32)
    own = y[w.doc]
    for c in range(N_INPUTS):  # a column at a time keeps the driver small
        # documents of each label that have a slot
        doc, slot = np.divmod(np.unique(w.doc * np.int64(N_INPUTS * SLOTS) + codes[:, c]), N_INPUTS * SLOTS)
        positive += np.bincount(slot, y[doc], N_INPUTS * SLOTS)
        negative += np.bincount(slot, 1 - y[doc], N_INPUTS * SLOTS)
        # what a training document reads leaves out its own label
        mine = codes[:, c]
        inputs[:, c] = evidence(np.maximum(positive[mine] - own, 0), np.maximum(negative[mine] - (1 - own), 0), base, how.strength)
    inputs[codes % SLOTS == 0] = 0
    del codes
    table = evidence(positive, negative, base, how.strength)
    table[np.arange(N_INPUTS) * SLOTS] = 0
    starts, docs = window_starts(w)
    score = np.array([np.sort(inputs[s : s + WINDOW].max(axis=1))[-4:].sum() for s in starts])
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in p.items()}
    # a toxic document counts as much as the others together do for their number, up to threefold
    weights, step = np.where(y > 0, min(3.0, float((y == 0).sum() / y.sum())), 1.0).astype(np.float32), 0
    for epoch in range(how.epochs):
        if epoch:
            score = np.concatenate([forward(p, *gather(inputs, w, starts[a : a + 2048], docs[a : a + 2048])) for a in range(0, len(starts), 2048)])
        order = np.lexsort((score, docs))
        top = order[np.append(docs[order][1:] != docs[order][:-1], True)]
        rng.shuffle(top)
        rate = how.rate * (1 - epoch / how.epochs) + 1e-3
        for a in range(0, len(top), how.batch):
            some = top[a : a + how.batch]
            x, mask = gather(inputs, w, starts[some], docs[some])
            g, step = gradients(p, x, mask, y[docs[some]], weights[docs[some]]), step + 1
            for k, value in g.items():
                m, v = moments[k]
                m += 0.1 * (value - m)
                v += 0.001 * (value * value - v)
                p[k] -= (rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return Network(p, table)


def training_rows(docs: DataFrame, labels: DataFrame, text: str, key: str, label: str, how: Training) -> list[tuple[int, str]]:
    """(label, text) of at most how.positives and how.negatives labelled rows that are not held out.

    A key that is labelled twice counts as labelled 1 if one of its labels is. Rows without
    label, text or key, and texts over how.max_chars, are not learned from.
    """
    marks = labels.filter(F.col(label).isin(0, 1)).groupBy(F.col(key).alias("key")).agg(F.max(label).cast("int").alias("label"))
    return labelled_texts(docs.filter(~held_out(F.col(f"`{key}`"))), marks, text, key, {1: how.positives, 0: how.negatives}, how.max_chars)


def score_toxicity(df: DataFrame, network: Network, text: str = "text", key: str = "doc_id", threshold: float = 0.7) -> DataFrame:
    """One row per row of df: key, held_out, score (0 to 1) and predicted (score >= threshold).

    Null and blank texts get the score of no words. Null keys count as not held out.
    """
    ship(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(network)  # a few MB, whatever the size of df
    rows = df.select(as_key(key), F.col(f"`{text}`").alias("text"))

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = [shared.value.logits(group) for _, group in pieces(pdf["text"].tolist())]
            yield pd.DataFrame({"key": pdf["key"], "score": sigmoid(np.concatenate(found)) if found else []})

    made = rows.mapInPandas(score, "key string, score double")
    made = made.select("key", held_out(F.col("key")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
    return with_key(made, df, key)


def toxicity(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "toxic", how: Training = Training()) -> DataFrame:
    """Train on the labelled rows that are not held out, and score every row of docs."""
    rows = training_rows(docs, labels, text, key, label, how)  # bounded by `how`
    return score_toxicity(docs, train([t for _, t in rows], [y for y, _ in rows], how), text, key)
