"""The block index of the k-NN search: equal to brute force, and its work
grows with the rows on clustered data."""

import math

import numpy as np
import pandas as pd
import pytest

from tessera.operators import knn
from tessera.operators import ml as M


def _frame(spark, x, ids=None, extra=None):
    ids = range(len(x)) if ids is None else ids
    rows = [(i, *[None if np.isnan(v) else float(v) for v in r], *(() if extra is None else (extra[n],))) for n, (i, r) in enumerate(zip(ids, x))]
    id_type = "string" if isinstance(rows[0][0], str) else "long"
    return spark.createDataFrame(rows, f"id {id_type}, a double, b double, c double" + ("" if extra is None else ", g string")).repartition(5)


def _brute(x, ids, queries, k, target=None, groups=None):
    ids = np.array(ids, object)
    order = np.argsort(ids.astype(str) if isinstance(ids[0], str) else ids.astype(int), kind="stable")
    out = {}
    for q in queries:
        d = knn.nan_dist(x[q:q + 1], x)[0]
        d[q] = np.nan
        if target is not None:
            if not np.isnan(x[q, target]):
                continue
            d[np.isnan(x[:, target])] = np.nan
        if groups is not None:
            d[[g != groups[q] for g in groups]] = np.nan
        ok = [i for i in order if not np.isnan(d[i])]
        out[ids[q]] = [ids[i] for i in sorted(ok, key=lambda i: d[i])[:k]]   # sorted is stable: ties by id
    return {q: v for q, v in out.items() if v}


def _got(found, target="_all"):
    out = {}
    for r in found.where(f"target = '{target}'").orderBy("qid", "rank").collect():
        out.setdefault(r.qid, []).append(r.did)
    return out


def _points(n, seed, gaps=0.15):
    """Clusters, a grid with many ties, and one point that a third of the rows share."""
    rng = np.random.default_rng(seed)
    x = np.concatenate([rng.normal(size=(n // 3, 3)) + 20 * rng.integers(0, 6, (n // 3, 1)), rng.integers(0, 4, (n // 3, 3)).astype(float),
                        np.tile([1.5, 1.5, 1.5], (n - 2 * (n // 3), 1))])
    x[rng.random(x.shape) < gaps] = np.nan
    return x[rng.permutation(n)]


@pytest.mark.parametrize("direct, text", [(0, False), (0, True), (100, True)])
def test_equal_to_brute_force_with_gaps_ties_and_a_hot_value(spark, monkeypatch, direct, text):
    monkeypatch.setattr(knn, "BLOCK_ROWS", 25)
    monkeypatch.setattr(knn, "DIRECT_CELLS", direct)
    x = _points(420, 3)
    ids = [f"r{i:04d}" for i in range(420)] if text else list(range(420))
    df = _frame(spark, x, ids)
    got = knn.knn_search(df, df, "id", ["a", "b", "c"], k=4, exclude_self=True)
    assert _got(got) == _brute(x, ids, range(420), 4)


def test_targets_and_groups(spark, monkeypatch):
    monkeypatch.setattr(knn, "BLOCK_ROWS", 20)
    monkeypatch.setattr(knn, "DIRECT_CELLS", 0)
    x = _points(300, 5, gaps=0.25)
    ids = list(range(300))
    df = _frame(spark, x)
    found = knn.knn_search(df.where("a is null or b is null or c is null"), df, "id", ["a", "b", "c"], k=5, targets=["a", "b", "c"], exclude_self=True)
    found = found.persist()
    for j, t in enumerate("abc"):
        assert _got(found, t) == _brute(x, ids, range(300), 5, target=j)
    found.unpersist()
    groups = [None if i % 11 == 0 else "hot" if i % 3 else f"g{i % 4}" for i in ids]
    df = _frame(spark, x, extra=groups)
    got = knn.knn_search(df, df, "id", ["a", "b", "c"], k=3, exclude_self=True, by="g")
    assert _got(got) == _brute(x, ids, ids, 3, groups=groups)


def test_few_donors_no_donors_and_empty_rows(spark, monkeypatch):
    monkeypatch.setattr(knn, "DIRECT_CELLS", 0)
    x = np.array([[1, 2, 3], [np.nan] * 3, [4, np.nan, np.nan], [np.nan, 5, np.nan]], float)
    df = _frame(spark, x)
    got = knn.knn_search(df, df, "id", ["a", "b", "c"], k=5, exclude_self=True)
    assert _got(got) == _brute(x, [0, 1, 2, 3], range(4), 5) == {0: [2, 3], 2: [0], 3: [0]}
    assert knn.knn_search(df, df.limit(0), "id", ["a", "b", "c"], k=5).count() == 0
    assert knn.knn_search(df.limit(0), df, "id", ["a", "b", "c"], k=5).count() == 0


def test_bounds_never_exceed_a_distance():
    rng = np.random.default_rng(1)
    x, q = rng.normal(size=(200, 4)), rng.normal(size=(50, 4)) * 3
    x[:, 2] = np.nan
    q[rng.random(q.shape) < 0.3] = np.nan
    tree = knn.grow(x[:, [0, 1, 3]], 9)
    assert tree.parts == 9
    part = tree.part_of(x[:, [0, 1, 3]])
    low = np.array([[np.nan if j == 2 else x[part == p, j].min() for j in range(4)] for p in range(9)])
    high = np.array([[np.nan if j == 2 else x[part == p, j].max() for j in range(4)] for p in range(9)])
    cells = knn.Cells(np.array(["-"] * 9, object), np.bincount(part), low, high, {})
    bound, dist = cells.bounds(q, np.arange(9)), knn.nan_dist(q, x)
    for p in range(9):
        least = np.nan_to_num(dist[:, part == p], nan=np.inf).min(axis=1)
        assert (bound[:, p] <= least * (1 + 1e-12)).all()


def test_work_grows_with_the_rows_on_clustered_data(spark, monkeypatch):
    """Distances and rows sent to tasks, at four times the rows: a power below
    1.3 (all pairs of blocks: 2)."""
    monkeypatch.setattr(knn, "BLOCK_ROWS", 100)
    rng = np.random.default_rng(9)
    work = []
    for n in (3_000, 12_000):
        x = rng.normal(size=(n, 3)) + rng.uniform(-1000, 1000, (n // 100, 3)).repeat(100, axis=0)
        df = _frame(spark, x)
        report = {}
        assert knn.knn_search(df, df, "id", ["a", "b", "c"], k=5, exclude_self=True, report=report).count() == 5 * n
        work.append(report)
    for what in ("distances", "shuffled"):
        assert math.log(work[1][what] / work[0][what], 4) < 1.3, work
    assert work[1]["distances"] < 12_000 ** 2 / 10


def test_imputed_values_with_nan_gaps_and_a_constant(spark):
    x = np.array([[1, 1, 5], [1, np.nan, 5], [2, 3, 5], [3, 4, 5], [np.nan] * 3], float)
    out = {r.id: r for r in M.knn_impute(_frame(spark, x), "id", ["a", "b", "c"], k=2).collect()}
    assert out[1].b == 2.0 and out[1].a == 1.0
    assert (out[4].a, out[4].b, out[4].c) == (7 / 4, 8 / 3, 5.0)   # no coordinate: the column means


def test_arrays_of_a_search_do_not_follow_the_queries():
    """The peak of memory of a task's search, at ten times the queries; the
    neighbours are those of one block."""
    import tracemalloc

    rng = np.random.default_rng(4)
    d, peak = rng.integers(0, 40, (2_000, 2)).astype(float), []
    vals = {"b": np.where(rng.random(2_000) < 0.2, np.nan, d[:, 1])}
    for n in (1_000, 10_000):
        q = rng.integers(0, 40, (n, 2)).astype(float)
        q[rng.random(n) < 0.3, 1] = np.nan
        miss = {"b": np.isnan(q[:, 1])}
        tracemalloc.start()
        found = pd.concat(knn._top_k(q, np.arange(n), miss, d, np.arange(2_000), vals, ["_all", "b"], 4), ignore_index=True)
        peak.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    assert peak[1] < 2 * peak[0], peak
    dist = knn.nan_dist(q, d)
    for t in ("_all", "b"):
        mine = dist if t == "_all" else np.where(np.isnan(vals["b"])[None, :], np.nan, dist)
        want = np.argsort(np.where(np.isnan(mine), np.inf, mine), axis=1, kind="stable")[:, :4]
        rows = np.arange(10_000) if t == "_all" else np.flatnonzero(miss["b"])
        got = found[found["target"] == t].groupby("_q")["did"].agg(list)
        assert got.index.tolist() == rows.tolist() and got.tolist() == want[rows].tolist()
