"""Whitening of embeddings onto the leading components of their covariance.

Entries become whole numbers, x = floor(scale * c) + shift, so counts and sums
are exact. The covariance (divisor n, centred by the exact mean before
multiplying) is summed on the cluster; the driver gets one d x d matrix.

Its leading components come from spectrum slicing. By Sylvester's law the
number of positive pivots of an LDL^T factorisation of V - s I is the number
of eigenvalues above s. V is brought to tridiagonal form by reflections first,
so such a count costs O(d), and bisection on counts gives every leading
eigenvalue an interval of its own. Rayleigh quotient iteration from inside the
interval converges cubically to its eigenvector; where it leaves the interval,
the interval is halved and the iteration starts again. Counts on both sides of
each result certify that it has the number it is given. Eigenvalues that
can't be told apart at working precision share an interval; their vectors are
kept orthogonal and numbered as found.

Defined cases: rows whose vector is null, empty or holds null, NaN or infinite
entries are dropped, so are vectors with entries beyond 2**61 after scaling and vectors of
another length than the most frequent one (ties: the longer); null and
repeated ids stay, each with its rows; an eigenvalue that is zero at working
precision has no component (equal vectors, or one vector: no rows);
``deviation`` is null where it exceeds a long; an empty table gives no rows;
other columns are ignored whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import materialise, prepare

SCALE = 64
SHIFT = 1_000_000
COMPONENTS = 32
ROWS = 20_000  # vectors that are multiplied at once
_EPS = np.finfo(float).eps


# ------------------------------------------------------------ symmetric eigenproblem

def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and off-diagonal of a tridiagonal matrix with the eigenvalues
    of the symmetric ``a`` (Householder reflections)."""
    a = a.copy()
    n = len(a)
    for k in range(n - 2):
        x = a[k + 1:, k]
        norm = np.linalg.norm(x)
        if norm == 0:
            continue
        u = x.copy()
        u[0] += np.copysign(norm, x[0])
        u /= np.linalg.norm(u)
        p = a[k + 1:, k + 1:] @ u
        w = p - (u @ p) * u
        a[k + 1:, k + 1:] -= 2 * (np.outer(u, w) + np.outer(w, u))
        a[k + 1, k] = a[k, k + 1] = -np.copysign(norm, x[0])
    return np.diag(a).copy(), np.diag(a, -1).copy()


def above(diagonal: np.ndarray, off: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    """For each shift s, the number of eigenvalues above it: positive pivots of
    the LDL^T factorisation of T - s I."""
    shifts = np.asarray(shifts, float)
    tiny = max(_EPS * (np.abs(diagonal).max(initial=0.0) + np.abs(off).max(initial=0.0)), np.finfo(float).tiny) * _EPS
    pivot = diagonal[0] - shifts
    count = (pivot > 0).astype(int)
    for d, b in zip(diagonal[1:], off):
        pivot = np.where(np.abs(pivot) < tiny, -tiny, pivot)
        pivot = (d - shifts) - b * b / pivot
        count += pivot > 0
    return count


def _isolate(diagonal: np.ndarray, off: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Intervals (low, high] of the k largest eigenvalues, largest first: each
    holds that one alone or is as narrow as the precision allows."""
    reach = np.abs(np.concatenate([off, [0]])) + np.abs(np.concatenate([[0], off]))
    span = float((np.abs(diagonal) + reach).max())
    low = np.full(k, float((diagonal - reach).min()) - 4 * _EPS * span - np.finfo(float).tiny)
    high = np.full(k, float((diagonal + reach).max()) + 4 * _EPS * span + np.finfo(float).tiny)
    number = np.arange(1, k + 1)
    for _ in range(200):
        shared = above(diagonal, off, low) - above(diagonal, off, high) > 1
        if not (shared & (high - low > 8 * _EPS * span)).any():
            break
        middle = (low + high) / 2
        reaches = above(diagonal, off, middle) >= number
        low = np.where(shared & reaches, middle, low)
        high = np.where(shared & ~reaches, middle, high)
    return low, high


def leading(v: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The (at most) k largest eigenvalues of a covariance, falling, and their
    unit vectors as columns; none for eigenvalues that are zero at working precision."""
    n = len(v)
    diagonal, off = tridiagonal(v)
    span = float(np.abs(v).sum(axis=1).max(initial=0.0))
    zero = 4 * n * _EPS * span
    k = min(k, int(above(diagonal, off, np.array([zero]))[0])) if span else 0
    if not k:
        return np.zeros(0), np.zeros((n, 0))
    lows, highs = _isolate(diagonal, off, k)
    values, vectors = np.zeros(k), np.zeros((n, k))
    slack = 8 * n * _EPS * span
    rng = np.random.default_rng(1)
    eye = np.eye(n)

    def solve(shift: float, b: np.ndarray) -> np.ndarray:
        for nudge in (0.0, _EPS, 8 * _EPS, 64 * _EPS):
            try:
                x = np.linalg.solve(v - (shift + nudge * span) * eye, b)
            except np.linalg.LinAlgError:
                continue
            norm = np.linalg.norm(x)
            if np.isfinite(norm) and norm > 0:
                return x / norm
        raise ArithmeticError("a shifted covariance can't be solved")

    for i in range(k):
        low, high = lows[i], highs[i]
        near = vectors[:, :i][:, values[:i] - high < 1e-3 * span]

        def clean(x: np.ndarray) -> np.ndarray:
            for _ in range(2):
                x = x - near @ (near.T @ x)
            return x / np.linalg.norm(x)

        for _ in range(80):
            shift = (low + high) / 2
            x = clean(rng.standard_normal(n))
            x = clean(solve(shift, clean(solve(shift, x))))
            for _ in range(8):
                e = float(x @ v @ x)
                if np.linalg.norm(v @ x - e * x) <= 4 * _EPS * span:
                    break
                x = clean(solve(e, x))
            e = float(x @ v @ x)
            over, under = above(diagonal, off, np.array([e + slack, e - slack]))  # is it the one with number i + 1?
            if over <= i < under and np.linalg.norm(v @ x - e * x) <= 64 * n * _EPS * span:
                break
            if above(diagonal, off, np.array([shift]))[0] > i:
                low = shift
            else:
                high = shift
        else:
            raise ArithmeticError(f"component {i + 1} was not found in its interval")
        values[i], vectors[:, i] = e, x
    order = np.argsort(-values, kind="stable")  # only such as share an interval can change places
    values, vectors = values[order], vectors[:, order]
    number = np.arange(1, k + 1)
    if (above(diagonal, off, values + 2 * slack) >= number).any() or (above(diagonal, off, values - 2 * slack) < number).any():
        raise ArithmeticError("counts don't certify the numbering of the components")
    return values, vectors


# ------------------------------------------------------------ on the cluster

def _scaled(batch: pa.RecordBatch, length: int | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, positions, x) of the usable vectors of a batch, for each
    length in it (or the given one), at most ``ROWS`` at once."""
    column = batch.column("vector")
    sizes = np.asarray(pc.fill_null(pc.list_value_length(column), 0))
    for size in [length] if length else sorted(set(sizes[sizes > 0].tolist())):
        of_size = np.flatnonzero(sizes == size)
        for at in range(0, len(of_size), ROWS):
            where = of_size[at:at + ROWS]
            flat = column.take(pa.array(where)).flatten().cast(pa.float64())
            c = pc.fill_null(flat, np.nan).to_numpy(zero_copy_only=False).reshape(-1, size)
            with np.errstate(over="ignore", invalid="ignore"):
                c = np.floor(c * SCALE)
                good = (np.abs(c) <= 2.0 ** 61).all(axis=1)
            if good.any():
                yield size, where[good], c[good].astype(np.int64) + SHIFT


@dataclass
class Model:
    """Exact mean of x (``pivot`` + ``rest`` / n, 0 <= rest < n) and the components."""

    length: int
    n: int
    pivot: np.ndarray
    rest: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.pivot).astype(float) - np.array([r / self.n for r in self.rest])

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ (self.vectors / np.sqrt(self.values))

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """The sum over dimensions of (n x - S)^2, exact; null beyond a long."""
        y = x - self.pivot
        reach = self.n * (float(np.abs(y).max(initial=0)) + 1)
        if reach < 2.0 ** 62 and reach * reach * self.length < 2.0 ** 62:
            t = y * self.n - np.array(self.rest, np.int64)
            return (t * t).sum(axis=1).tolist()
        exact = [sum((self.n * int(a) - r) ** 2 for a, r in zip(row, self.rest)) for row in y]
        return [d if d < 1 << 63 else None for d in exact]


def _moments(vectors: DataFrame) -> tuple[int, int, list[int]]:
    """Most frequent length of usable vectors, their number and sums of x."""
    schema = "length int, dim int, n long, s decimal(38,0)"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, list] = {}
        for batch in batches:
            for size, _, x in _scaled(batch):
                n, s = total.setdefault(size, [0, [0] * size])
                # halves of the numbers, so that no partial sum leaves a long
                sums = [(int(a) << 31) + int(b) for a, b in zip((x >> 31).sum(axis=0), (x & 0x7FFFFFFF).sum(axis=0))]
                total[size] = [n + len(x), [a + b for a, b in zip(s, sums)]]
        for size, (n, s) in total.items():
            yield pa.RecordBatch.from_pydict({
                "length": pa.array([size] * size, pa.int32()), "dim": pa.array(range(size), pa.int32()),
                "n": pa.array([n] * size, pa.int64()), "s": pa.array([int(v) for v in s], pa.decimal128(38, 0))})

    sums = vectors.mapInArrow(run, schema).groupBy("length", "dim").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    sums = materialise(sums, "whitening-sums")
    best = sums.where("dim = 0").orderBy(F.desc("n"), F.desc("length")).first()
    if best is None:
        return 0, 0, []
    rows = sums.where(F.col("length") == best["length"]).orderBy("dim").collect()  # one row a dimension
    return best["length"], best["n"], [int(r["s"]) for r in rows]


def _gram(vectors: DataFrame, length: int, side: int, transform) -> np.ndarray:
    """Sum over all vectors of the outer product of ``transform(x)`` (``side``
    columns) with itself."""
    i, j = np.triu_indices(side)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((side, side))
        for batch in batches:
            for _, _, x in _scaled(batch, length):
                d = transform(x)
                total += d.T @ d
        yield pa.RecordBatch.from_pydict({"cell": pa.array(np.arange(len(i)), pa.int64()), "v": pa.array(total[i, j])})

    cells = vectors.mapInArrow(run, "cell long, v double").groupBy("cell").agg(F.sum("v").alias("v"))
    out = np.zeros((side, side))
    for row in cells.collect():  # side * (side + 1) / 2 numbers
        out[i[row["cell"]], j[row["cell"]]] = out[j[row["cell"]], i[row["cell"]]] = row["v"]
    return out


def learn(vectors: DataFrame, components: int = COMPONENTS) -> Model | None:
    """The model of a table with the column ``vector``; None without usable vectors."""
    length, n, sums = _moments(vectors)
    if not n:
        return None
    pivot = [s // n for s in sums]
    model = Model(length, n, np.array(pivot, np.int64), [s - n * p for s, p in zip(sums, pivot)], np.zeros(0), np.zeros((length, 0)), 0.0)
    covariance = _gram(vectors, length, length, model.centred) / n
    model.values, model.vectors = leading(covariance, components)
    model.trace = float(np.trace(covariance))
    return model


def whiten(table: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row per usable vector and component: the key, component (from 1),
    n, deviation, whitened, explained and identity_error (of all rows together)."""
    prepare(table.sparkSession)
    vectors = table.select(F.col(key).cast("long").alias("key"), F.col(vector).cast("array<double>").alias("vector"))
    schema = f"{key} long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    model = learn(vectors.select("vector"), components)
    k = len(model.values) if model else 0
    if not k:
        return table.sparkSession.createDataFrame([], schema)

    def with_one(x: np.ndarray) -> np.ndarray:  # the column of ones gives the means
        return np.column_stack([model.whitened(x), np.ones(len(x))])

    gram = _gram(vectors.select("vector"), model.length, k + 1, with_one) / model.n
    mean = gram[:k, k]
    error = float(np.abs(gram[:k, :k] - np.outer(mean, mean) - np.eye(k)).max())
    explained = model.values / model.trace

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, where, x in _scaled(batch, model.length):
                m = len(x)
                yield pa.RecordBatch.from_arrays([
                    batch.column("key").take(pa.array(np.repeat(where, k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * k, model.n)), pa.array(model.deviations(x), pa.int64()).take(pa.array(np.repeat(np.arange(m), k))),
                    pa.array(model.whitened(x).ravel()), pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error))],
                    names=[key, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return vectors.mapInArrow(run, schema)
