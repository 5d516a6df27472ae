"""Moments and regressions of all folds at once, against numpy per fold and
the distributed optimiser."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import folds
from tessera.operators import ml as M

COLS = ["a", "b", "c"]


def _table(n=400, seed=2, shift=0.0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 3)) * [1, 30, 0.2] + shift
    x[:, 2] += 0.05 * x[:, 0]
    y = (rng.random(n) < 1 / (1 + np.exp(-(x[:, 0] - shift) + 0.05 * (x[:, 1] - shift)))).astype(int)
    return x, y, rng.integers(0, 4, n)


def _frame(spark, x, y, fold):
    return spark.createDataFrame([(i, *map(float, r), int(t), int(f)) for i, (r, t, f) in enumerate(zip(x, y, fold))],
                                 "id long, a double, b double, c double, y int, fold int").repartition(5)


@pytest.mark.parametrize("shift", [0.0, 1e7])
def test_moments_are_total_minus_fold(spark, shift):
    x, y, fold = _table(shift=shift)
    got = folds.moments(_frame(spark, x, y, fold), COLS, "fold")
    assert sorted(got) == [-1, 0, 1, 2, 3]
    for k, m in got.items():
        rows = x[fold != k]
        assert m.n == len(rows)
        assert np.allclose(m.mean, rows.mean(axis=0), rtol=1e-12)
        assert np.allclose(m.covariance, np.cov(rows, rowvar=False), rtol=1e-9, atol=1e-9)
        assert (m.low == rows.min(axis=0)).all() and (m.high == rows.max(axis=0)).all()


def _loss_gradient(x, y, intercept, w, C):
    p = 1 / (1 + np.exp(-(x @ w + intercept)))
    return np.append(C * x.T @ (p - y) + w, C * (p - y).sum())


def test_every_model_is_the_minimum_and_that_of_the_optimiser(spark):
    x, y, fold = _table()
    df = _frame(spark, x, y, fold)
    seen = folds.moments(df, COLS, "fold")
    models = {k: folds.prepared(m, COLS, scale=["a", "b"]) for k, m in seen.items() if k >= 0}
    fits = folds.newton(df, COLS, "y", models, C=2.0, fold="fold")
    for k, (intercept, w) in fits.items():
        rows = x[fold != k].copy()
        lo, hi = rows.min(axis=0), rows.max(axis=0)
        rows[:, :2] = ((rows - lo) / (hi - lo))[:, :2]
        assert np.abs(_loss_gradient(rows, y[fold != k], intercept, w, 2.0)).max() < 1e-6
    part = df.where("fold <> 2").withColumns({c: (F.col(c) - float(seen[2].low[i])) / float(seen[2].high[i] - seen[2].low[i]) for i, c in enumerate("ab")})
    lr = M.LogisticRegression(featuresCol="features", labelCol="y", regParam=1 / (2.0 * part.count()), standardization=False, maxIter=500, tol=1e-13)
    ref = lr.fit(M.assemble(part, COLS).withColumn("y", F.col("y").cast("double")))
    assert np.allclose(fits[2][1], ref.coefficients.toArray(), atol=1e-6) and abs(fits[2][0] - ref.intercept) < 1e-6


def test_components_of_every_fold_equal_numpy(spark):
    x, y, fold = _table()
    seen = folds.moments(_frame(spark, x, y, fold), COLS, "fold")
    for k, m in seen.items():
        a = folds.prepared(m, COLS, scale=["b"], n_components=2)
        rows = x[fold != k].copy()
        rows[:, 1] = (rows[:, 1] - rows[:, 1].min()) / (rows[:, 1].max() - rows[:, 1].min())
        values, vectors = np.linalg.eigh(np.cov(rows, rowvar=False))
        want = (rows - rows.mean(axis=0)) @ vectors[:, ::-1][:, :2]
        got = x[fold != k] @ a.matrix + a.offset
        assert np.allclose(np.abs(got), np.abs(want), atol=1e-9)
        assert np.allclose(np.var(got, axis=0, ddof=1), values[::-1][:2], rtol=1e-9)


def test_cross_validation_and_its_number_of_jobs(spark):
    x, y, _ = _table(300)
    df = _frame(spark, x, y, np.zeros(300, int)).drop("fold")
    jobs = {}
    for k in (3, 10):
        spark.sparkContext.setJobGroup(f"folds-{k}", "")
        out = M.cross_validate(df, "id", COLS, "y", k, scale=COLS).collect()
        jobs[k] = len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"folds-{k}"))
        spark.sparkContext.setJobGroup("other", "")
        assert len(out) == k and sum(r.n for r in out) == 300
        fold = {r.id: r.fold for r in M.stratified_folds(df, "id", "y", k).collect()}
        own = np.array([fold[i] for i in range(300)])
        for r in out:
            rows, test = x[own != r.fold], x[own == r.fold]
            lo, hi = rows.min(axis=0), rows.max(axis=0)
            z = (rows - lo) / (hi - lo)
            w = np.zeros(4)
            for _ in range(50):  # plain Newton on this fold alone
                d = np.column_stack([z, np.ones(len(z))])
                p = 1 / (1 + np.exp(-d @ w))
                ridge = np.array([1, 1, 1, 0.0])
                w = w - np.linalg.solve((d * (p * (1 - p))[:, None]).T @ d + np.diag(ridge), d.T @ (p - y[own != r.fold]) + ridge * w)
            right = ((test - lo) / (hi - lo) @ w[:3] + w[3] > 0) == (y[own == r.fold] == 1)
            assert r.accuracy == pytest.approx(right.mean(), abs=1e-12)
        accs = [r.accuracy for r in out]
        assert out[0].mean_accuracy == pytest.approx(np.mean(accs)) and out[0].std_accuracy == pytest.approx(np.std(accs))
    assert abs(jobs[3] - jobs[10]) <= 3   # a Newton step more or less, not a chain per fold


def test_odd_labels_missing_values_and_constant_columns(spark):
    x, y, fold = _table(60)
    x[:, 1] = 5.0
    df = _frame(spark, x, y, fold)
    out = M.cross_validate(df, "id", COLS, "y", 3, scale=COLS, n_components=2).collect()
    assert len(out) == 3
    one = M.cross_validate(df.withColumn("y", F.lit(1)), "id", COLS, "y", 3).collect()
    assert [r.accuracy for r in one] == [1.0, 1.0, 1.0]
    none = df.withColumn("y", F.when(F.col("id") % 4 > 0, F.col("y")))
    assert sum(r.n for r in M.cross_validate(none, "id", COLS, "y", 3).collect()) == 45
    with pytest.raises(Exception, match="labels must be 0 and 1"):
        M.cross_validate(df.withColumn("y", F.col("id") % 3), "id", COLS, "y", 3)
    with pytest.raises(Exception, match="missing values"):
        M.cross_validate(df.withColumn("a", F.when(F.col("id") > 0, F.col("a"))), "id", COLS, "y", 3)
    assert M.cross_validate(df.limit(0), "id", COLS, "y", 3).count() == 0
