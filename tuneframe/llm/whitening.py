"""Whitening of embeddings by shifted CholeskyQR.

The centred vectors are a tall matrix A whose rows lie in Spark. A pass adds up the Gram
matrix of the rows so far, Q = A / R1 / R2 ..., and its Cholesky factor orthogonalises them
further by a triangular solve in each task. The first factor is shifted, so that it exists for
any A; the passes end when Q is orthonormal. The factors' product R has A's singular values and right
singular vectors to the precision of A itself, where the covariance would square its condition.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tuneframe.llm.ship import ship
from tuneframe.session import settle

SCALE, OFFSET = 64, 1_000_000
#: Rows of a task that are worked on at once.
STEP = 4096
PASSES = 12
_UNIT = np.finfo(float).eps / 2


def quantised(vector: Column) -> Column:
    """floor(SCALE * entry) + OFFSET of each entry; null where the vector or an entry is null, not finite or beyond 2**55."""
    wide = F.transform(vector, lambda c: c.cast("double") * SCALE)
    usable = F.forall(wide, lambda c: F.coalesce(F.abs(c) < float(1 << 61), F.lit(False)))
    return F.when(usable, F.transform(wide, lambda c: F.floor(c).cast("long") + OFFSET))


def solve_upper(rows: np.ndarray, r: np.ndarray) -> np.ndarray:
    """rows times the inverse of the upper triangle r, column by column."""
    out = np.empty_like(rows)
    for j in range(len(r)):
        out[:, j] = (rows[:, j] - out[:, :j] @ r[:j, j]) / r[j, j]
    return out


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """x - sums / n: whole numbers are subtracted before the division, as far as 64 bits hold them."""
    near = np.array([s // n for s in sums])
    rest = np.array([(s % n) / n for s in sums])
    return (x - near).astype(float) - rest


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list:
    """Sum over dimensions of (n * x - sums)**2 of each row, exactly; null where 64 bits do not hold it."""
    near, rest = [s // n for s in sums], [s % n for s in sums]
    off = x - np.array(near)
    if (n * (int(np.abs(off).max()) + 1)) ** 2 * len(sums) < 1 << 63:
        return ((n * off - np.array(rest)) ** 2).sum(axis=1).tolist()
    exact = [sum((n * int(v) - r) ** 2 for v, r in zip(row, rest)) for row in off]
    return [v if v < 1 << 63 else None for v in exact]


def added(rows: DataFrame, make: Callable[[np.ndarray], np.ndarray], width: int) -> np.ndarray:
    """The sum over all rows' matrices make(x), each of `width` columns.

    A task adds up its own rows and sends one row for each line of its matrix; lines meet by
    their number. The driver gets the sum, as many numbers as the matrix has.
    """

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for pdf in batches:
            for at in range(0, len(pdf), STEP):
                found = make(np.stack(pdf["x"].iloc[at : at + STEP].to_numpy()))
                total = found if total is None else total + found
        if total is not None:
            yield pd.DataFrame({"line": range(len(total)), "values": list(total)})

    def whole(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"line": pdf["line"].iloc[:1], "values": [np.sum(np.stack(pdf["values"].to_numpy()), axis=0)]})

    schema = "line int, values array<double>"
    lines = rows.select("x").mapInPandas(partial, schema).groupBy("line").applyInPandas(whole, schema).collect()
    out = np.zeros((len(lines), width))
    for r in lines:
        out[r["line"]] = r["values"]
    return out


@dataclass(frozen=True)
class Whitening:
    """Of the fit: rows, sums of x, components (dimensions, components), their variances and the sum of all variances."""

    n: int
    sums: list[int]
    components: np.ndarray
    variances: np.ndarray
    trace: float
    passes: int

    def project(self, x: np.ndarray) -> np.ndarray:
        return centred(x, self.n, self.sums) @ (self.components / np.sqrt(self.variances))


def cholesky(gram: np.ndarray, shift: float) -> np.ndarray:
    """Upper factor of gram + shift; the shift grows until there is one."""
    while True:
        try:
            return np.linalg.cholesky(gram + shift * np.eye(len(gram))).T
        except np.linalg.LinAlgError:
            shift = max(10 * shift, 100 * len(gram) * _UNIT * max(np.abs(gram).max(), np.finfo(float).tiny))


def fit_whitening(rows: DataFrame, n: int, sums: list[int], n_components: int) -> Whitening:
    """rows(x): n vectors of one length with the given sums.

    Components of no more variance than rounding would give are left out.
    """
    d = len(sums)
    factors: list[np.ndarray] = []

    def gram_of(x: np.ndarray) -> np.ndarray:
        q = centred(x, n, sums)
        for r in factors:
            q = solve_upper(q, r)
        return q.T @ q

    for passes in range(1, PASSES + 1):
        gram = added(rows, gram_of, d)
        if not gram.any():  # all vectors are equal
            return Whitening(n, sums, np.zeros((d, 0)), np.zeros(0), 0.0, passes)
        if passes > 2 and np.abs(gram - np.diag((np.diag(gram) > 0.5).astype(float))).max() < 8 * d * _UNIT:
            break
        shift = 11 * (n * d + d * (d + 1)) * _UNIT * np.linalg.norm(gram, 2) if passes == 1 else 0.0
        factors.append(cholesky(gram, shift))
    r = np.eye(d)
    for factor in factors:
        r = factor @ r
    _, sigma, turned = np.linalg.svd(r)
    variances = sigma**2 / n
    kept = int((variances > 8 * d * 2 * _UNIT * variances[0]).sum())
    components = turned[: min(kept, n_components)]
    signs = np.sign(components[np.arange(len(components)), np.abs(components).argmax(axis=1)])  # the largest entry is positive
    return Whitening(n, sums, (components * signs[:, None]).T, variances[: len(components)], float(variances.sum()), passes)


def whitened(df: DataFrame, vector: str = "embedding", key: str = "vec_id", n_components: int = 16) -> DataFrame:
    """Rows (key, component, n, deviation, whitened, explained, identity_error) for each usable row of df and each component.

    Rows are left out whose vector is null or empty, holds a null, a number that is not finite or one beyond
    2**55, or is of another length than most (of lengths equally often, the longest). x is the
    quantised vector; the fit is over the n distinct x. deviation is the exact sum of
    (n * x - sums)**2, null where it exceeds 64 bits. Components are numbered from 1 by falling variance,
    each with its largest entry positive; there are fewer than n_components where the vectors have no more
    dimensions, or none of more variance than rounding. Equal rows give equal results, a null key is kept, and an
    empty table, or one of equal vectors, gives no rows. Other columns are not looked at.
    """
    ship(df.sparkSession)
    rows = df.select(F.col(f"`{key}`").alias("key"), quantised(F.col(f"`{vector}`")).alias("x")).filter("size(x) > 0")
    lengths = rows.groupBy(F.size("x").alias("d")).agg(F.count("*").alias("n"))
    usual = lengths.orderBy(F.desc("n"), F.desc("d")).first()
    schema = f"`{key}` {df.schema[key].dataType.simpleString()}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if usual is None:
        return df.sparkSession.createDataFrame([], schema)
    d = usual["d"]
    rows = rows.filter(F.size("x") == d)
    distinct = settle(rows.select("x").distinct())
    columns = distinct.select(F.posexplode("x").alias("i", "v")).groupBy("i").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("s"), F.count("*").alias("n")).collect()
    sums, n = [0] * d, columns[0]["n"]
    for r in columns:
        sums[r["i"]] = int(r["s"])
    fit = fit_whitening(distinct, n, sums, n_components)
    k = fit.components.shape[1]
    if not k:
        return df.sparkSession.createDataFrame([], schema)

    def moments(x: np.ndarray) -> np.ndarray:
        w = fit.project(x)
        return np.vstack([w.T @ w, w.sum(axis=0)])

    found = added(distinct, moments, k)
    mean = found[k] / n
    error = float(np.abs(found[:k] / n - np.outer(mean, mean) - np.eye(k)).max())

    @F.pandas_udf("deviation long, whitened array<double>")
    def project(vectors: pd.Series) -> pd.DataFrame:
        parts = [np.stack(vectors.iloc[at : at + STEP].to_numpy()) for at in range(0, len(vectors), STEP)]
        exact = [v for x in parts for v in deviations(x, n, sums)]
        return pd.DataFrame({"deviation": pd.array(exact, "Int64"), "whitened": [w for x in parts for w in fit.project(x)]})

    made = rows.select("key", project("x").alias("m")).select("key", "m.deviation", F.posexplode("m.whitened").alias("at", "whitened"))
    explained = F.array(*[F.lit(float(v / fit.trace)) for v in fit.variances])
    return made.select(
        F.col("key").alias(key), (F.col("at") + 1).cast("int").alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        F.get(explained, F.col("at")).alias("explained"), F.lit(error).alias("identity_error"),
    )
