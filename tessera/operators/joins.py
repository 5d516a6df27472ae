"""Joins J1-J12.

Strategy is left to Catalyst + AQE: a side measured small at runtime is
broadcast (a checked size), otherwise both sides shuffle on the key and
AQE splits skewed partitions. Explicit ``broadcast`` hints are used only for
tables whose size is bounded by construction (a list of distinct keys of a
dimension, a top-n, one row per calendar day).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Keys = str | Sequence[str] | Sequence[tuple[str, str]]


def _pairs(on: Keys) -> list[tuple[str, str]]:
    if isinstance(on, str):
        return [(on, on)]
    return [(k, k) if isinstance(k, str) else (k[0], k[1]) for k in on]


def join(a: DataFrame, b: DataFrame, on: Keys, how: str = "inner") -> DataFrame:
    """Equi-join on one or several keys, same or differently named.

    Same-named keys are merged into one column (for ``outer`` the merged key is
    the coalesce of both sides, as pandas ``merge`` does); a differently named
    right key is kept as its own column.
    """
    pairs = _pairs(on)
    if all(l == r for l, r in pairs):
        return a.join(b, [l for l, _ in pairs], how)
    cond = None
    for l, r in pairs:
        e = a[l] == b[r]
        cond = e if cond is None else cond & e
    return a.join(b, cond, how)


def join_all(tables: Sequence[DataFrame], on: Sequence[str], how: str = "inner") -> DataFrame:
    """Chain of equi-joins on a common key (a = b = c)."""
    out = tables[0]
    for t in tables[1:]:
        out = out.join(t, list(on), how)
    return out


class CardinalityError(ValueError):
    pass


def join_validated(a: DataFrame, b: DataFrame, on: Sequence[str], how: str = "left",
                   validate: str = "many_to_one") -> DataFrame:
    """Join after checking key uniqueness on the side(s) that must be unique.

    The probe is an action (a distributed ``groupBy(on).count() > 1`` with
    ``limit(1)``), run before the join is returned; it raises
    ``CardinalityError`` instead of returning a fanned-out result.
    """
    on = list(on)
    sides = {"many_to_one": [("right", b)], "one_to_many": [("left", a)],
             "one_to_one": [("left", a), ("right", b)], "many_to_many": []}[validate]
    for name, side in sides:
        dup = (side.groupBy(*on).count().where(F.col("count") > 1).limit(1).collect())
        if dup:
            raise CardinalityError(f"{validate}: {name} keys not unique, e.g. {dup[0].asDict()}")
    return a.join(b, on, how)


def restrict_to(df: DataFrame, ids: DataFrame, on: Keys) -> DataFrame:
    """Keep rows whose key is in the id list (left semi join; the id side
    is deduplicated by the join itself and never fans rows out)."""
    pairs = _pairs(on)
    if all(l == r for l, r in pairs):
        return df.join(ids, [l for l, _ in pairs], "left_semi")
    cond = None
    for l, r in pairs:
        e = df[l] == ids[r]
        cond = e if cond is None else cond & e
    return df.join(ids, cond, "left_semi")


def join_then_first(fine: DataFrame, coarse: DataFrame, on: Sequence[str],
                    key: Sequence[str], order: Sequence, coarse_order: Sequence | None = None,
                    how: str = "inner") -> DataFrame:
    """Attach coarse rows (e.g. one per month) to fine rows (e.g. daily) and
    keep one row per ``key`` -- the first by ``order`` (ending in a unique column).

    Same rows as join-then-dedup, but both sides are reduced first: the fine side
    to one row per ``key`` and the coarse side to one row per join key (by
    ``coarse_order``; omit it when the coarse side is already unique). Each
    reduction is a ``min_by`` hash aggregation combined map-side, so the join
    cannot fan out and its shuffle carries one row per key. Where ``on`` is not
    part of ``key``, a key's rows may match or not, so for an inner join those
    without a match are dropped (semi join) before the first one is taken.
    """
    from tessera.operators.frame import first_per_key

    if how == "inner" and not set(on) <= set(key):
        fine = fine.join(coarse.select(*on), list(on), "left_semi")
    f1 = first_per_key(fine, list(key), list(order))
    c1 = first_per_key(coarse, list(on), list(coarse_order)) if coarse_order else coarse
    return f1.join(c1, list(on), how)


def map_values(df: DataFrame, c: str, mapping: DataFrame, key: str, value: str,
               out: str | None = None) -> DataFrame:
    """Look a column up in a (key, value) mapping table; unmatched -> NULL.
    The mapping must have unique keys (checked size comes from AQE)."""
    m = mapping.select(F.col(key).alias("_k"), F.col(value).alias(out or value))
    return df.join(m, df[c] == m["_k"], "left").drop("_k")


def flag_match(df: DataFrame, other: DataFrame, on: Sequence[str], name: str = "matched") -> DataFrame:
    """1 when the key has a match in ``other``, else 0. ``other`` is reduced
    to distinct keys first, so matches never multiply rows."""
    keys = other.select(*on).distinct().withColumn(name, F.lit(1))
    return df.join(keys, list(on), "left").withColumn(name, F.coalesce(F.col(name), F.lit(0)))


def join_fill(a: DataFrame, b: DataFrame, on: Sequence[str], how: str = "left",
              fill: float = 0, cols: Sequence[str] | None = None) -> DataFrame:
    """Join, then fill the measures that came back missing with ``fill``."""
    j = a.join(b, list(on), how)
    cols = list(cols) if cols else [c for c in b.columns if c not in set(on)]
    return j.na.fill(fill, subset=cols)


def null_safe_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join in which a NULL key matches a NULL key; the key columns come
    from the left side. (Spark plans it as a hash or sort-merge join.)"""
    on = list(on)
    r = right.select(*[F.col(c).alias(f"_key_{c}") if c in on else F.col(c) for c in right.columns])
    cond = F.lit(True)
    for c in on:
        cond = cond & F.col(c).eqNullSafe(F.col(f"_key_{c}"))
    return left.join(r, cond, how).drop(*([] if how in ("left_semi", "left_anti") else [f"_key_{c}" for c in on]))
