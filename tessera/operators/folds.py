"""Models of all folds at once.

The rows of a table belong to folds; model i is fitted on the rows of all
folds but the i-th. One pass takes count, least and greatest values, sums and
cross products per fold (``moments``); what a model is trained on is the total
minus its own fold, so scaling and components of every model come from that
one scan. A logistic regression of every model then runs in one chain of
Newton steps: each pass over the rows returns gradient and curvature of all
models (``newton``), so the number of jobs doesn't depend on the number of folds.

What reaches the driver are a few p x p matrices per fold; rows stay where they
are, read from one checkpoint.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_STEPS = 60
PIVOT_ROWS = 100


@dataclass
class Moments:
    """n, mean and centred cross products of some rows, their least and greatest values."""

    n: int
    mean: np.ndarray
    cross: np.ndarray
    low: np.ndarray
    high: np.ndarray

    @property
    def covariance(self) -> np.ndarray:
        return self.cross / max(self.n - 1, 1)


@dataclass
class _Sums:
    n: float
    first: np.ndarray     # sums of x - pivot
    second: np.ndarray    # sums of (x - pivot)(x - pivot)'


def _rows(df: DataFrame, cols: Sequence[str], *more: str) -> DataFrame:
    return df.select(*more, *[F.col(c).cast("double").alias(c) for c in cols])


def _summed(df: DataFrame, run, keys: str = "fold int, cell int") -> list:
    """Sums, least and greatest values per cell of what tasks emit."""
    names = [k.split()[0] for k in keys.split(", ")]
    cells = df.mapInPandas(run, f"{keys}, v double").groupBy(*names)
    return cells.agg(F.sum("v").alias("sum"), F.min("v").alias("low"), F.max("v").alias("high")).collect()


def moments(df: DataFrame, cols: Sequence[str], fold: str | None = None) -> dict[int, Moments]:
    """Moments of the rows outside each fold (key: the fold left out), and of
    all rows (key -1). ``fold`` is an integer column. Sums are taken about a
    pivot near the data, so that nothing cancels. A row that misses a value raises."""
    from tessera.session import ship_package

    ship_package(df.sparkSession)
    cols = list(cols)
    p = len(cols)
    df = _rows(df, cols, F.col(fold).cast("int").alias("fold") if fold else F.lit(0).alias("fold"))
    some = df.select(*cols).limit(PIVOT_ROWS).toPandas().to_numpy(float)
    with np.errstate(all="ignore"):
        pivot = np.nan_to_num(np.median(some[~np.isnan(some).any(axis=1)], axis=0)) if len(some) else np.zeros(p)
    i, j = np.triu_indices(p)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[int, list] = {}
        for f in frames:
            x, own = f[cols].to_numpy(float), f["fold"].to_numpy()
            if np.isnan(x).any():
                raise ValueError(f"missing values in {cols}: fill them before")
            for k in np.unique(own):
                y = x[own == k]
                d = y - pivot
                new = [len(y), d.sum(axis=0), d.T @ d, y.min(axis=0), y.max(axis=0)]
                old = total.get(int(k))
                total[int(k)] = new if old is None else [old[0] + new[0], old[1] + new[1], old[2] + new[2], np.minimum(old[3], new[3]), np.maximum(old[4], new[4])]
        for k, (n, s, g, low, high) in total.items():
            # cells: the count, p sums, p (p + 1) / 2 products, p least and p greatest values
            v = np.concatenate([[n], s, g[i, j], low, high])
            yield pd.DataFrame({"fold": np.int32(k), "cell": np.arange(len(v), dtype=np.int32), "v": v})

    m = len(i)
    per: dict[int, np.ndarray] = {}
    for r in _summed(df, run):
        c = r["cell"]
        row = per.setdefault(r["fold"], np.zeros(1 + p + m + 2 * p))
        row[c] = r["sum"] if c < 1 + p + m else r["low"] if c < 1 + p + m + p else r["high"]

    def unpack(v: np.ndarray) -> _Sums:
        second = np.zeros((p, p))
        second[i, j] = v[1 + p:1 + p + m]
        second[j, i] = v[1 + p:1 + p + m]
        return _Sums(v[0], v[1:1 + p], second)

    sums = {k: unpack(v) for k, v in per.items()}
    total = _Sums(sum(s.n for s in sums.values()), sum((s.first for s in sums.values()), np.zeros(p)),
                  sum((s.second for s in sums.values()), np.zeros((p, p))))
    out = {}
    for left_out in [-1, *sums]:
        less = sums.get(left_out, _Sums(0, np.zeros(p), np.zeros((p, p))))
        n, first, second = total.n - less.n, total.first - less.first, total.second - less.second
        others = [v for k, v in per.items() if k != left_out]
        if n > 0:
            out[left_out] = Moments(int(n), pivot + first / n, second - np.outer(first, first) / n,
                                    np.min([v[1 + p + m:1 + p + m + p] for v in others], axis=0),
                                    np.max([v[1 + p + m + p:] for v in others], axis=0))
    return out


def components(covariance: np.ndarray, n: int) -> np.ndarray:
    """Loadings of the n leading components as columns; each one's largest
    loading is positive."""
    values, vectors = np.linalg.eigh(covariance)
    w = vectors[:, ::-1][:, :n]
    return w * np.where(np.take_along_axis(w, np.abs(w).argmax(axis=0)[None, :], 0)[0] < 0, -1.0, 1.0)


@dataclass
class Affine:
    """Features x @ matrix + offset."""

    matrix: np.ndarray
    offset: np.ndarray


def prepared(m: Moments, cols: Sequence[str], scale: Sequence[str] = (), n_components: int = 0) -> Affine:
    """What the training rows' moments make of a row: columns of ``scale`` to
    (x - least) / (greatest - least), a constant one to 0, then the leading
    components of all columns if asked for."""
    span = np.array([h - l if c in scale else 1.0 for c, l, h in zip(cols, m.low, m.high)])
    factor = np.where(span > 0, 1.0 / np.where(span > 0, span, 1.0), 0.0)
    start = np.array([l if c in scale else 0.0 for c, l in zip(cols, m.low)])
    if not n_components:
        return Affine(np.diag(factor), -start * factor)
    w = components(m.covariance * np.outer(factor, factor), min(n_components, len(cols)))
    return Affine(factor[:, None] * w, -(m.mean * factor) @ w)


def newton(df: DataFrame, cols: Sequence[str], label: str, models: dict[int, Affine], C: float = 1.0, fold: str | None = None,
           tol: float = 1e-9) -> dict[int, tuple[float, np.ndarray]]:
    """(intercept, weights) of an L2 logistic regression per model, the
    minimum of C * sum(logloss) + ||w||^2 / 2 over the rows outside its fold
    (all rows without ``fold``; the intercept is not penalised). Newton steps,
    halved where they overshoot; one job per step for all models. Labels are 0
    and 1; rows without a label don't count."""
    from tessera.session import ship_package

    ship_package(df.sparkSession)
    cols = list(cols)
    rows = _rows(df, cols, F.col(fold).cast("int").alias("fold") if fold else F.lit(-1).alias("fold"), F.col(label).cast("double").alias("_y"))
    rows = rows.where(F.col("_y").isNotNull())
    keys = list(models)
    size = {k: models[k].matrix.shape[1] + 1 for k in keys}
    tri = {k: np.triu_indices(size[k]) for k in keys}
    at = {k: np.zeros(size[k]) for k in keys}
    state = {k: None for k in keys}       # (loss, weights, step) of the best point so far
    active = set(keys)

    def run_at(weights: dict[int, np.ndarray]):
        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total = {k: [0.0, np.zeros(size[k]), np.zeros((size[k], size[k]))] for k in weights}
            for f in frames:
                x, y, own = f[cols].to_numpy(float), f["_y"].to_numpy(float), f["fold"].to_numpy()
                if not np.isin(y, (0.0, 1.0)).all():
                    raise ValueError("labels must be 0 and 1")
                for k, w in weights.items():
                    mine = own != k if fold else np.ones(len(x), bool)
                    z = np.column_stack([x[mine] @ models[k].matrix + models[k].offset, np.ones(int(mine.sum()))])
                    eta = z @ w
                    chance = 0.5 * (1.0 + np.tanh(0.5 * eta))
                    t = total[k]
                    t[0] += float((np.logaddexp(0.0, eta) - y[mine] * eta).sum())
                    t[1] += z.T @ (chance - y[mine])
                    t[2] += (z * (chance * (1 - chance))[:, None]).T @ z
            for k, (loss, g, h) in total.items():
                v = np.concatenate([[loss], g, h[tri[k]]])
                yield pd.DataFrame({"fold": np.int32(k), "cell": np.arange(len(v), dtype=np.int32), "v": v})
        return run

    for _ in range(MAX_STEPS):
        got = {k: np.zeros(1 + size[k] + len(tri[k][0])) for k in active}
        for r in _summed(rows, run_at({k: at[k] for k in active})):
            got[r["fold"]][r["cell"]] = r["sum"]
        for k in list(active):
            n = size[k]
            ridge = np.append(np.full(n - 1, 1.0 / C), 0.0)
            loss = got[k][0] + 0.5 * float(ridge @ (at[k] ** 2))
            old = state[k]
            if old is not None and loss > old[0] + 1e-12 * abs(old[0]) and np.abs(old[2]).max() > tol:
                state[k] = (old[0], old[1], old[2] / 2)
                at[k] = old[1] + state[k][2]
                continue
            g = got[k][1:1 + n] + ridge * at[k]
            h = np.zeros((n, n))
            h[tri[k]] = got[k][1 + n:]
            h = h + np.triu(h, 1).T + np.diag(ridge)
            step = -np.linalg.lstsq(h, g, rcond=None)[0]
            if np.abs(step).max() <= tol * (1 + np.abs(at[k]).max()):
                at[k] = at[k] + step
                active.discard(k)
                continue
            state[k] = (loss, at[k], step)
            at[k] = at[k] + step
        if not active:
            break
    return {k: (float(at[k][-1]), at[k][:-1]) for k in keys}


def scores(df: DataFrame, cols: Sequence[str], label: str, models: dict[int, Affine], fits: dict[int, tuple[float, np.ndarray]],
           fold: str) -> dict[int, tuple[int, int]]:
    """(rows, rows predicted right at 0.5) of each fold by the model that leaves it out."""
    cols = list(cols)
    rows = _rows(df, cols, F.col(fold).cast("int").alias("fold"), F.col(label).cast("double").alias("_y")).where(F.col("_y").isNotNull())

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            x, y, own = f[cols].to_numpy(float), f["_y"].to_numpy(float), f["fold"].to_numpy()
            for k in np.unique(own):
                intercept, w = fits[int(k)]
                mine = own == k
                right = ((x[mine] @ models[int(k)].matrix + models[int(k)].offset) @ w + intercept > 0) == (y[mine] == 1)
                yield pd.DataFrame({"fold": np.int32(k), "cell": np.arange(2, dtype=np.int32), "v": [float(mine.sum()), float(right.sum())]})

    got: dict[int, list[int]] = {}
    for r in _summed(rows, run):
        got.setdefault(r["fold"], [0, 0])[r["cell"]] = int(r["sum"])
    return {k: (v[0], v[1]) for k, v in got.items()}


def apply(df: DataFrame, cols: Sequence[str], a: Affine, names: Sequence[str]) -> DataFrame:
    """``names``: the features as columns (expressions over ``cols``)."""
    def feature(j: int):
        out = F.lit(float(a.offset[j]))
        for i, c in enumerate(cols):
            if a.matrix[i, j]:
                out = out + F.col(c).cast("double") * F.lit(float(a.matrix[i, j]))
        return out
    return df.withColumns({n: feature(j) for j, n in enumerate(names)})
