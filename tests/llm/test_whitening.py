"""Spectrum slicing and whitening against numpy's eigensolver and exact integers."""

import math

import numpy as np
import pytest

from tessera.llm import queries, whitening

from ..conftest import SF_SMALL


def _check(v, k):
    e, x = whitening.leading(v, k)
    want = np.sort(np.linalg.eigvalsh(v))[::-1]
    scale = want[0]
    assert np.allclose(e, want[:len(e)], rtol=0, atol=1e-13 * scale * len(v))
    assert np.abs(x.T @ x - np.eye(len(e))).max(initial=0) < 1e-11
    assert np.abs(v @ x - x * e).max(initial=0) < 1e-12 * scale * len(v)
    return e, x


@pytest.mark.parametrize("seed", range(4))
def test_leading_components_of_random_covariances(seed):
    rng = np.random.default_rng(seed)
    a = rng.standard_normal((300, 64)) * rng.uniform(0.5, 20, 64)
    e, x = _check(a.T @ a / 300, 32)
    assert len(e) == 32
    w, u = np.linalg.eigh(a.T @ a / 300)
    assert np.abs(np.abs((u[:, ::-1][:, :32] * x).sum(axis=0)) - 1).max() < 1e-10


def test_repeated_close_and_zero_eigenvalues():
    rng = np.random.default_rng(5)
    q, _ = np.linalg.qr(rng.standard_normal((20, 20)))
    for spectrum in ([5.0] * 4 + [3.0] * 16, [7, 7, 7 - 1e-13, 7 - 1e-10, 7 - 1e-6] + [1.0] * 15, [9, 4, 1e-3] + [0.0] * 17,
                     list(10.0 ** -np.arange(20)), [1.0] * 20):
        v = (q * np.array(spectrum)) @ q.T
        v = (v + v.T) / 2
        e, _ = _check(v, 12)
        assert len(e) == min(12, sum(s > 1e-13 for s in spectrum))
    assert len(_check(np.diag([3.0, 2.0, 1.0]), 5)[0]) == 3
    assert len(whitening.leading(np.zeros((4, 4)), 3)[0]) == 0
    assert len(_check(np.array([[2.5]]), 3)[0]) == 1


def test_counts_equal_the_spectrum():
    rng = np.random.default_rng(8)
    a = rng.standard_normal((30, 30))
    v = a + a.T
    d, off = whitening.tridiagonal(v)
    values = np.linalg.eigvalsh(v)
    shifts = np.linspace(values[0] - 1, values[-1] + 1, 101)
    assert (whitening.above(d, off, shifts) == [(values > s).sum() for s in shifts]).all()


SCHEMA = "vec_id long, embedding array<float>, label int, vector string, key string, n long"


def _brute(rows, k=32):
    good = [r for r in rows if r[1] and all(c is not None and math.isfinite(c) for c in r[1])]
    lengths = [len(r[1]) for r in good]
    if not good:
        return {}, 0
    length = max(set(lengths), key=lambda m: (lengths.count(m), m))
    good = [r for r in good if len(r[1]) == length]
    x = [[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in r[1]] for r in good]
    n, s = len(x), [sum(col) for col in zip(*x)]
    centred = np.array([[a - t / n for a, t in zip(row, s)] for row in x])
    e, u = np.linalg.eigh(centred.T @ centred / n)
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    dev = [sum((n * a - t) ** 2 for a, t in zip(row, s)) for row in x]
    return [(r[0], d, row) for r, d, row in zip(good, dev, centred @ u / np.sqrt(np.abs(e)))], e / np.trace(centred.T @ centred / n)


def _compare(got, rows, components=32):
    want, explained = _brute([tuple(r) for r in rows], components)
    by_row = {}
    for g in got:
        by_row.setdefault((g.vec_id, g.deviation), {}).setdefault(g.component, []).append(g)
    assert len(got) == len(want) * len(explained)
    sign = {}
    for vec_id, dev, white in want:
        for c, value in enumerate(white, 1):
            g = by_row[vec_id, dev][c][0]
            assert g.n == len(want) and abs(g.explained - explained[c - 1]) < 1e-12 and g.identity_error < 1e-9
            if abs(value) > 1e-6:
                sign.setdefault(c, np.sign(value * g.whitened))
                assert abs(g.whitened * sign[c] - value) < 1e-7


def test_odd_rows(spark):
    rng = np.random.default_rng(2)
    vectors = rng.standard_normal((60, 5)) * [9, 5, 3, 2, 1]
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(vectors)]
    rows += [(100, None), (101, []), (102, [1.0, None, 2.0, 3.0, 4.0]), (103, [float("nan")] * 5), (104, [float("inf")] + [0.0] * 4),
             (105, [1.0] * 4), (None, [0.5, 1.5, -2.0, 0.0, 1.0]), rows[3], rows[3]]
    table = spark.createDataFrame([(*r, 1, "clash", "clash", 3) for r in rows], SCHEMA).repartition(4)
    _compare(whitening.whiten(table).collect(), rows)
    _compare(whitening.whiten(table, components=2).collect(), rows, 2)


def test_large_entries_equal_vectors_and_no_rows(spark):
    make = lambda rows: spark.createDataFrame([(*r, 1, "", "", 1) for r in rows], SCHEMA)
    out = whitening.whiten(make([(1, [1e12, 0.0]), (2, [-1e12, 1.0]), (3, [0.0, 1e30]), (4, [5.0, 7.0])])).collect()
    # a float of 1e30 has no long; of the others, only the last stays near the mean: (3 * 320 - 320)^2 + (3 * 448 - 512)^2
    assert {(r.vec_id, r.deviation) for r in out} == {(1, None), (2, None), (4, 640 ** 2 + 832 ** 2)}
    assert all(r.identity_error < 1e-6 for r in out)
    assert whitening.whiten(make([(1, [1.0, 2.0])] * 3)).count() == 0
    assert whitening.whiten(make([(1, None)])).count() == 0
    empty = whitening.whiten(make([]))
    assert empty.count() == 0 and empty.columns[0] == "vec_id"


def test_op12_query(spark):
    rows = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").select("vec_id", "embedding").collect()
    _compare(queries.op12_spectrum_whitening(spark, SF_SMALL).collect(), rows)
