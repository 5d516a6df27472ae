"""Moments of blocks of columns against numpy, row by row definitions."""

import numpy as np
import pytest

from tessera.operators import gram as G
from tessera.operators import stats as S


def table(spark, x, parts=5):
    rows = [tuple(None if v is None else float(v) for v in r) for r in x]
    return spark.createDataFrame(rows, ", ".join(f"c{i} double" for i in range(len(x[0])))).repartition(parts)


def brute(x, i, j, complete=None):
    use = [r for r in x if all(r[k] is not None for k in (complete or (i, j)))]
    if not use:
        return 0, None, None, None, None, None
    a, b = np.array([r[i] for r in use], float), np.array([r[j] for r in use], float)
    return len(use), a.mean(), b.mean(), ((a - a.mean()) ** 2).sum(), ((b - b.mean()) ** 2).sum(), ((a - a.mean()) * (b - b.mean())).sum()


def test_moments_of_pairs_and_of_complete_rows(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(700, 4)) * [1, 1e-3, 50, 1] + [0, 5, 1e6, -2]   # one column far from zero
    x[:, 1] += 1e-3 * x[:, 0]
    x = [[None if rng.random() < 0.1 else v for v in r] for r in x]
    x += [[None] * 4] + [x[0]] * 20
    got = G.moments(table(spark, x), [G.Block("pairs", ("c0", "c1", "c2", "c3")), G.Block("model", ("c3", "c0", "c1"), complete=True)]).collect()
    seen = set()
    for r in got:
        at = (0, 1, 2, 3) if r.block == "pairs" else (3, 0, 1)
        want = brute(x, at[r.i], at[r.j], None if r.block == "pairs" else at)
        assert r.n == want[0]
        for value, w in zip((r.mean_i, r.mean_j, r.ss_i, r.ss_j), want[1:5]):
            assert value == pytest.approx(w, rel=1e-9)
        assert abs(r.c - want[5]) <= 1e-9 * (want[3] * want[4]) ** 0.5
        seen.add((r.block, r.i, r.j))
    assert len(seen) == len(got) == 10 + 6


def test_odd_values_and_empty_tables(spark):
    x = [[1.0, float("nan"), None], [2.0, 3.0, None], [4.0, 1.0, None], [5.0, None, float("inf")]]
    got = {(r.i, r.j): r for r in G.moments(table(spark, x), [G.Block("b", ("c0", "c1", "c2"))]).collect()}
    assert got[0, 0].n == 4 and got[0, 0].mean_i == 3.0
    assert got[0, 1].n == 3 and np.isnan(got[0, 1].c) and np.isnan(got[1, 1].mean_i)
    assert got[1, 2].n == 0 and got[1, 2].c is None
    assert got[0, 2].n == 1 and np.isnan(got[0, 2].c)
    empty = table(spark, x).where("false")
    assert all(r.n == 0 and r.mean_i is None for r in G.moments(empty, [G.Block("b", ("c0", "c1"))]).collect())
    m = {(r["var"], r["with_var"]): r for r in S.corr_matrix(empty, ["c0", "c1"]).collect()}
    assert len(m) == 4 and all(r.r is None for r in m.values())


def test_no_row_is_multiplied(spark):
    x = [[float(i), float(i * i % 7), float(i % 5)] for i in range(60)]
    df = table(spark, x)
    plan = S.corr_matrix(df, ["c0", "c1", "c2"])._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "MapInArrow" in plan
    cached = spark._jsc.getPersistentRDDs().size()
    fit = S.ols(df, "c0", ["c1", "c2"])
    assert spark._jsc.getPersistentRDDs().size() == cached
    a = np.array(x)
    want = np.linalg.lstsq(np.c_[np.ones(60), a[:, 1:]], a[:, 0], rcond=None)[0]
    assert np.allclose([r.estimate for r in fit.coefficients.collect()], want, rtol=1e-9)


def test_names_with_odd_characters_and_a_constant(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3), (2.0, 2.0, 5), (4.0, 2.0, 9)], "`a b` double, k double, n int")
    m = {(r["var"], r["with_var"]): r for r in S.corr_matrix(df, ["a b", "k", "n"]).collect()}
    assert m["a b", "n"].r == pytest.approx(1.0) and m["a b", "k"].r is None and m["k", "k"].std_var == 0.0
    assert m["n", "k"].n_var == 3 and m["n", "k"].mean_var == pytest.approx(17 / 3)
