"""Moments of blocks of columns: counts, means and centred cross-products of
all pairs, from one pass that reads each row once.

A task turns its Arrow batches into matrices of values X and of presence P
and adds up P'P, X'P, (X*X)'P and X'X, so a row costs one record of as many
numbers as it has columns, not one per pair of columns. What leaves a task
is a row per pair; Spark sums these by pair. Values are taken relative to a
constant near them (the mean of a few rows), so the sums don't cancel; the
constant changes nothing but rounding.

A null is absent. A pair counts the rows in which both columns are present;
in a ``complete`` block only rows with all of its columns count. NaN and
infinite values are present: statistics of a pair that meets one are NaN.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows whose mean the values are taken relative to.
SHIFT_ROWS = 1000

_SUMS = ["n", "odd", "si", "sj", "qi", "qj", "c"]


@dataclass(frozen=True)
class Block:
    """Columns whose pairs are wanted."""

    name: str
    columns: tuple[str, ...]
    complete: bool = False


def _near(df: DataFrame, columns: Sequence[str]) -> np.ndarray:
    row = df.limit(SHIFT_ROWS).agg(*[F.avg(c).alias(f"_{i}") for i, c in enumerate(columns)]).first()
    near = np.array([np.nan if v is None else v for v in row], float)
    return np.where(np.isfinite(near), near, 0.0)


def _values(batch: pa.RecordBatch, near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values less ``near`` (0 where absent) and presence, a row per column."""
    present = np.stack([np.asarray(c.is_valid()) for c in batch.columns])
    x = np.stack([c.fill_null(0.0).to_numpy(zero_copy_only=False) for c in batch.columns]).astype(float)
    return np.where(present, x - near[:, None], 0.0), present


def _sums(x: np.ndarray, present: np.ndarray) -> np.ndarray:
    """The seven sums of all pairs of the columns in ``x``."""
    odd = present & ~np.isfinite(x)
    x = np.where(odd, 0.0, x)
    p, o = present.astype(float), odd.astype(float)
    meets = o @ p.T
    s, q = x @ p.T, (x * x) @ p.T
    return np.stack([p @ p.T, meets + meets.T, s, s.T, q, q.T, x @ x.T])


def moments(df: DataFrame, blocks: Sequence[Block]) -> DataFrame:
    """(block, i, j, n, mean_i, mean_j, ss_i, ss_j, c): for each block and pair of
    its columns (by place, i <= j) the rows in which both are present and,
    over these, means, centred sums of squares and of products. Columns
    must be doubles. Pairs that never meet have n = 0 and nulls."""
    columns = list(dict.fromkeys(c for b in blocks for c in b.columns))
    near = _near(df, columns)
    places = [np.array([columns.index(c) for c in b.columns]) for b in blocks]
    complete = [b.complete for b in blocks]
    keys = [(k, i, j) for k, at in enumerate(places) for i in range(len(at)) for j in range(i, len(at))]
    pick = [np.triu_indices(len(at)) for at in places]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [np.zeros((len(_SUMS), len(at), len(at))) for at in places]
        for batch in batches:
            if not batch.num_rows:
                continue
            x, present = _values(batch, near)
            for k, at in enumerate(places):
                mine, here = x[at], present[at]
                if complete[k]:
                    rows = here.all(0)
                    mine, here = mine[:, rows], here[:, rows]
                total[k] += _sums(mine, here)
        flat = np.concatenate([t[:, a, b] for t, (a, b) in zip(total, pick)], axis=1)
        block, i, j = (pa.array([key[m] for key in keys], pa.int32()) for m in range(3))
        yield pa.RecordBatch.from_arrays([block, i, j, *map(pa.array, flat)], names=["block", "i", "j", *_SUMS])

    parts = df.select(*columns).mapInArrow(run, "block int, i int, j int, " + ", ".join(f"{s} double" for s in _SUMS))
    t = parts.groupBy("block", "i", "j").agg(*[F.sum(s).alias(s) for s in _SUMS])
    n, odd = F.col("n"), F.col("odd") > 0
    to = F.array(*[F.lit(float(v)) for v in near])
    place = F.array(*[F.array(*[F.lit(int(v)) for v in at]) for at in places])
    shift = lambda which: to[place[F.col("block")][F.col(which)]]

    def stat(value):
        return F.when(n > 0, F.when(odd, F.lit(float("nan"))).otherwise(value))

    centred = lambda q, a, b: q - F.try_divide(F.col(a) * F.col(b), n)
    return t.select(
        F.array(*[F.lit(b.name) for b in blocks])[F.col("block")].alias("block"), "i", "j", n.cast("bigint").alias("n"),
        stat(F.try_divide("si", n) + shift("i")).alias("mean_i"), stat(F.try_divide("sj", n) + shift("j")).alias("mean_j"),
        stat(F.greatest(centred(F.col("qi"), "si", "si"), F.lit(0.0))).alias("ss_i"),
        stat(F.greatest(centred(F.col("qj"), "sj", "sj"), F.lit(0.0))).alias("ss_j"),
        stat(centred(F.col("c"), "si", "sj")).alias("c"))
