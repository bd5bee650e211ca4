"""Whitening against a dense solution on the driver."""

import math
import random

import numpy as np
import pytest

from tuneframe.llm import whitening
from tuneframe.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int"


def usable(vectors):
    return [(i, [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v]) for i, v in vectors if v is not None and all(c is not None and math.isfinite(c) for c in v)]


def by_brute_force(vectors, k=16):
    """(vec_id, x) rows, n, exact deviations, projections up to sign, and shares of the variance."""
    rows = usable(vectors)
    fit = sorted({tuple(x) for _, x in rows})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    a = np.array([[(n * c - s) / n for c, s in zip(x, sums)] for x in fit])
    e, v = np.linalg.eigh(a.T @ a / n)
    e, v = e[::-1][:k], v[:, ::-1][:, :k]
    out = {}
    for i, x in rows:
        centred = np.array([(n * c - s) / n for c, s in zip(x, sums)])
        out.setdefault(i, []).append((sum((n * c - s) ** 2 for c, s in zip(x, sums)), centred @ v / np.sqrt(e)))
    return n, out, e / np.trace(a.T @ a / n)


def check(made, vectors, k=16, exact=1e-7):
    n, rows, shares = by_brute_force(vectors, k)
    got = {}
    for r in made.collect():
        assert r["n"] == n and r["identity_error"] < 1e-9
        got.setdefault(r["vec_id"], {}).setdefault(r["component"], []).append(r)
    assert got.keys() == rows.keys()
    parts = range(1, min(k, len(shares)) + 1)
    signs = {}
    for i, mine in rows.items():
        assert sorted(got[i]) == list(parts)
        for c in parts:
            assert sorted(r["deviation"] for r in got[i][c]) == sorted(d if d < 1 << 63 else None for d, _ in mine)
            for (_, want), r in zip(sorted(mine, key=lambda x: x[0]), sorted(got[i][c], key=lambda r: r["deviation"])):
                assert abs(r["explained"] - shares[c - 1]) < 1e-9 * shares[c - 1] + 1e-15
                if abs(want[c - 1]) > 1e-3:
                    sign = signs.setdefault(c, np.sign(want[c - 1]) * np.sign(r["whitened"]))
                    assert abs(sign * r["whitened"] - want[c - 1]) < exact * (1 + abs(want[c - 1]))


def vectors_of(n, d, seed=0, scale=None):
    rng = np.random.default_rng(seed)
    wide = rng.standard_normal((n, d)) * (scale if scale is not None else np.linspace(3, 0.5, d))
    return [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(wide @ np.linalg.qr(rng.standard_normal((d, d)))[0])]


def test_query(spark, sf_dir):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    check(QUERIES["op12_whitening"](spark, sf_dir), rows)


@pytest.mark.parametrize("n, d", [(300, 24), (200, 5), (40, 16)])
def test_odd_rows(spark, n, d):
    rows = vectors_of(n, d)
    same = [(10_000 + i, rows[3][1]) for i in range(n)]
    odd = [(-1, None), (-2, []), (-3, [None] + [0.5] * (d - 1)), (-4, [float("nan")] * d), (-5, [float("inf")] * d), (-6, [1.0] * (d + 1)), (0, rows[0][1]), (0, rows[5][1]), (None, rows[7][1])]
    df = spark.createDataFrame([(i, v, 1) for i, v in [*rows, *same, *odd]], SCHEMA).repartition(4)
    check(whitening.whitened(df), [x for x in [*rows, *same, *odd] if x[1] is None or len(x[1]) == d])


def test_variances_far_apart(spark):
    # entries from 1 to 10**5: the covariance's condition is some 10**10
    rows = vectors_of(500, 12, scale=np.logspace(5, 0, 12))
    check(whitening.whitened(spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<double>, label int")), rows, exact=1e-5)


def test_dimensions_without_variance_are_no_components(spark):
    rows = [(i, [*v, 0.25, v[0], 2.0]) for i, v in vectors_of(200, 6)]
    made = whitening.whitened(spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA))
    assert sorted({r["component"] for r in made.collect()}) == [1, 2, 3, 4, 5, 6]
    assert max(r["identity_error"] for r in made.collect()) < 1e-8
    equal = spark.createDataFrame([(i, [1.0, 2.0], 0) for i in range(9)], SCHEMA)
    assert whitening.whitened(equal).count() == 0


def test_huge_entries(spark):
    rows = [(i, [random.Random(i).uniform(-1, 1) * 2.0**54, float(i)]) for i in range(9)] + [(50, [1e300, 0.0])]
    made = whitening.whitened(spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<double>, label int")).collect()
    assert {r["vec_id"] for r in made} == set(range(9)) and all(r["deviation"] is None for r in made)


def test_empty_and_other_names(spark):
    assert whitening.whitened(spark.createDataFrame([], SCHEMA)).count() == 0
    odd = spark.createDataFrame([(f"v{i}", [float(i), float(i * i % 7)], i, "x", 0.5) for i in range(8)], "`my id` string, `my vec` array<double>, key int, x string, n double")
    made = whitening.whitened(odd, vector="my vec", key="my id")
    assert made.columns[0] == "my id" and made.count() == 16


def test_solve_and_shift():
    rng = np.random.default_rng(2)
    r = np.triu(rng.standard_normal((7, 7))) + 4 * np.eye(7)
    rows = rng.standard_normal((30, 7))
    assert np.allclose(whitening.solve_upper(rows, r) @ r, rows)
    gram = np.ones((3, 3))
    factor = whitening.cholesky(gram, 0.0)
    assert np.allclose(factor.T @ factor, gram, atol=1e-9) and np.allclose(np.tril(factor, -1), 0)
