"""Distributed ranking: exact row numbers, prefix sums and quantiles without
a single-partition window and without holding a group's values in one
aggregation buffer.

Quantiles are selected: sketches bracket each order statistic, exact counts
say which bracket holds it, and only the values in there are numbered.

Row numbers and prefix sums: approximate quantiles of the first order column cut the key range
into ~equal buckets (``Bucketizer``: a binary search on the JVM); rows are
ordered inside (group, bucket) by a window; each (group, bucket) gets the
total of the buckets before it from a table with one row per (group,
bucket). Equal key values always fall in the same bucket, so ties are
handled inside one window. The bucket count grows with the data
(``ROWS_PER_BUCKET``), so a task sorts a bounded number of rows even when
one group holds a third of the table.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.joins import null_safe_join

ROWS_PER_BUCKET = 2_000_000
MIN_BUCKETS = 16


GRID = 256   # boundaries computed in the counting pass; reused when enough
SKETCH = 2_000             # accuracy of the sketches that propose bounds of quantiles
BROADCAST_GROUPS = 50_000  # groups whose bounds are broadcast (a row of a few dozen numbers each); more are joined by a shuffle


def _grid(b: int) -> list[float]:
    return [i / b for i in range(1, b)]


def range_splits(df: DataFrame, key: Column, rows_per_bucket: int, min_b: int) -> list[float]:
    """Range boundaries of ``key`` (for ``Bucketizer``) giving about
    ``rows_per_bucket`` rows each.

    One pass returns the row count and GRID approximate quantiles; a second
    pass runs only when more than GRID buckets are needed."""
    r = df.agg(F.count(F.lit(1)).alias("n"),
               F.percentile_approx(key, _grid(GRID), 10000).alias("q")).first()
    n = r["n"]
    b = max(min_b, math.ceil(n / rows_per_bucket))
    if b <= GRID:
        qs = r["q"] or []
        qs = [qs[round(i * GRID / b) - 1] for i in range(1, b)] if qs else []
    else:
        qs = df.agg(F.percentile_approx(key, _grid(b), max(10000, 20 * b)).alias("q")).first()["q"] or []
    inner = {float(q) for q in qs if q is not None and math.isfinite(q)} or {0.0}   # an empty table has none
    return [-math.inf, *sorted(inner), math.inf]


def _buckets(df: DataFrame, first: str) -> DataFrame:
    # as Spark sorts: NULL before all values, NaN behind them
    v = F.col(first).cast("double")
    kd = F.when(v.isNull(), F.lit(-math.inf)).when(F.isnan(v), F.lit(math.inf)).otherwise(v)
    splits = range_splits(df, kd, ROWS_PER_BUCKET, MIN_BUCKETS)
    return Bucketizer(splits=splits, inputCol="_kd", outputCol="_b", handleInvalid="keep").transform(
        df.withColumn("_kd", kd)).drop("_kd")


def prefix_sum(df: DataFrame, order: Sequence[str], weight: str | None = None, by: Sequence[str] = (),
               out: str = "prefix") -> DataFrame:
    """Exclusive running sum of ``weight`` (1 per row when None) in ascending
    ``order`` within each ``by`` group. ``order[0]`` must be numeric (NULL sorts
    first); NULL groups are groups; the full ``order`` must be unique within a group for a defined result
    (ties in ``order`` share no guarantee of sequence)."""
    order, by = list(order), list(by)
    b = _buckets(df, order[0])
    w = F.col(weight) if weight else F.lit(1)
    b = b.withColumn("_pw", w.cast("bigint") if weight is None else w)
    totals = b.groupBy(*by, "_b").agg(F.sum("_pw").alias("_t"))
    wo = Window.partitionBy(*by).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*by, "_b", F.coalesce(F.sum("_t").over(wo), F.lit(0)).alias("_off"))
    wi = Window.partitionBy(*by, "_b").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = b.withColumn("_loc", F.coalesce(F.sum("_pw").over(wi), F.lit(0)))
    j = null_safe_join(local, offsets, by + ["_b"])
    return j.withColumn(out, F.col("_off") + F.col("_loc")).drop("_b", "_pw", "_loc", "_off")


def row_index(df: DataFrame, order: Sequence[str] | str, by: Sequence[str] = (), out: str = "idx") -> DataFrame:
    """Exact 0-based row number in ascending ``order`` (unique within ``by``).
    A first key that is not a number is ranked over ranges of the whole
    (by, order) tuple instead (``scan``): any type, NULL first, and a value
    that many rows share is spread by the keys after it."""
    order = [order] if isinstance(order, str) else list(order)
    if not isinstance(df.schema[order[0]].dataType, (T.NumericType, T.BooleanType)):
        from tessera.operators.scan import segmented

        return segmented(df, list(by), order, number=out)
    return prefix_sum(df, order, None, by, out).withColumn(out, F.col(out).cast("bigint"))


def _attached(rows: DataFrame, small: DataFrame, by: list[str], broadcast: bool) -> DataFrame:
    return null_safe_join(rows, F.broadcast(small) if broadcast else small, by)


#: Of one probability ``_p``: the 0-based positions of its two order statistics
#: among ``_m`` values, and the cell of a position ``_at`` from the counts up to each bound.
_POSITIONS = "array(cast(floor(_p * (_m - 1)) as bigint), least(cast(floor(_p * (_m - 1)) as bigint) + 1, _m - 1))"
_CELL_OF = "size(filter(_le, _x -> _x <= _at))"


def select_candidates(df: DataFrame, c: str | Column, probs: Sequence[float], by: Sequence[str] = ()) -> tuple[DataFrame, DataFrame, bool]:
    """The values that can be the wanted order statistics, and where to look.

    A mergeable sketch per group (``percentile_approx``) proposes bounds a
    little below and above each probability. A second pass counts the values
    up to each bound, which says exactly in which cell between bounds every
    order statistic lies; a third keeps the values of those cells alone. The
    counts are exact, so a bad sketch makes cells larger and nothing wrong.

    Returns (candidates: ``by``, _cell, _v, _w rows of that value; targets:
    ``by``, _pi, _fr, _which, _cell and _k, the position in the cell; whether
    the groups are few enough to broadcast). No value is read again for either."""
    from tessera.session import cut_lineage

    by = list(by)
    col = F.col(c) if isinstance(c, str) else c
    v = df.select(*by, col.cast("double").alias("_v")).where(F.col("_v").isNotNull() & ~F.isnan("_v"))
    width = 1.5 / SKETCH
    grid = sorted({min(1.0, max(0.0, p + d)) for p in probs for d in (-width, width)})
    nb = len(grid)
    sketch = F.percentile_approx("_v", [float(p) for p in grid], SKETCH).alias("_q")
    names = [f"_b{i}" for i in range(nb)]
    counts = [F.array(*[F.expr(f"count_if(_v <= {n})") for n in names]).alias("_le"), F.count(F.lit(1)).alias("_m")]
    if by:
        bounds, few = _written(v.groupBy(*by).agg(sketch).select(*by, *[F.col("_q")[i].alias(n) for i, n in enumerate(names)]))
        marks, _ = _written(_attached(v, bounds, by, few).groupBy(*by).agg(*counts))
    else:
        bounds, few = None, True
        q = v.agg(sketch).first()["_q"] or [None] * nb
        v = v.withColumns({n: F.lit(x).cast("double") for x, n in zip(q, names)})
        marks, _ = _written(v.agg(*counts).where("_m > 0"))
    each = f"array({', '.join(f'{float(p)!r}D' for p in probs)})"
    wanted = marks.select(*by, F.expr(f"array_distinct(flatten(transform({each}, _p -> transform({_POSITIONS}, _at -> {_CELL_OF}))))").alias("_wanted"))
    if by:
        v = _attached(v, null_safe_join(bounds, wanted, by), by, few)
    else:
        row = wanted.first()
        v = v.withColumn("_wanted", F.array(*[F.lit(x) for x in (row[0] if row else [])]).cast("array<int>"))
    near = v.withColumn("_cell", F.expr(" + ".join(f"cast(_v > {n} as int)" for n in names))).where("array_contains(_wanted, _cell)")
    candidates = cut_lineage(near.groupBy(*by, "_cell", "_v").agg(F.count(F.lit(1)).alias("_w")))
    targets = marks.select(*by, "_le", "_m", F.posexplode(F.expr(each)).alias("_pi", "_p"))
    targets = targets.select(*by, "_le", "_pi", F.expr("_p * (_m - 1) - floor(_p * (_m - 1))").alias("_fr"), F.posexplode(F.expr(_POSITIONS)).alias("_which", "_at"))
    targets = targets.withColumn("_cell", F.expr(_CELL_OF))
    targets = targets.select(*by, "_pi", "_fr", "_which", "_cell", F.expr("_at - concat(array(0L), _le)[_cell]").alias("_k"))
    return candidates, targets, few


def _written(groups: DataFrame) -> tuple[DataFrame, bool]:
    """A row per group without its lineage, and whether there are at most
    BROADCAST_GROUPS: those come through the driver, more are checkpointed."""
    from tessera.session import cut_lineage

    rows = groups.limit(BROADCAST_GROUPS + 1).collect()
    if len(rows) <= BROADCAST_GROUPS:
        return groups.sparkSession.createDataFrame(rows, groups.schema), True
    return cut_lineage(groups), False


def quantiles(df: DataFrame, c: str | Column, probs: Sequence[float], by: Sequence[str] = (),
              names: Sequence[str] | None = None) -> DataFrame:
    """Exact quantiles with linear interpolation (R type 7, numpy default,
    SQL ``percentile`` / ``quantile_cont``) of ``c`` per ``by`` group; NULL and
    NaN values are left out, a NULL group is a group.

    By selection (``select_candidates``): three passes without a sort or a
    shuffle of all values, then the candidates, a small share of the rows, are
    numbered by distributed prefix sums and each group's 2 x len(probs) order
    statistics are picked by a join. Returns ``by`` + one column per
    probability (``names`` or ``q0, q1, ...``); without ``by`` one row, NULL
    where there is no value."""
    by = list(by)
    names = list(names or [f"q{i}" for i in range(len(probs))])
    candidates, targets, few = select_candidates(df, c, probs, by)
    pre = prefix_sum(candidates, ["_v"], "_w", by + ["_cell"], out="_lo")
    hit = _attached(pre, targets, by + ["_cell"], few).where((F.col("_lo") <= F.col("_k")) & (F.col("_lo") + F.col("_w") > F.col("_k")))

    def at(i: int, which: int) -> Column:
        return F.max(F.when((F.col("_pi") == i) & (F.col("_which") == which), F.col("_v")))

    cols = []
    for i, n in enumerate(names):
        fr = F.max(F.when(F.col("_pi") == i, F.col("_fr")))
        a, b = at(i, 0), at(i, 1)
        cols.append(F.when((fr == 0) | (a == b), a).otherwise(a + fr * (b - a)).alias(n))
    return hit.groupBy(*by).agg(*cols)


def quantile_values(df: DataFrame, c: str | Column, probs: Sequence[float]) -> list:
    """Exact type-7 quantiles of a whole column as Python floats (the
    distributed work is the same as ``quantiles`` without groups)."""
    return list(quantiles(df, c, probs).first())


def ntile_from_index(idx: Column, m: Column, n: int) -> Column:
    """``ntile(n)`` from a 0-based row index and the group size: the first
    m mod n tiles get one extra row (as SQL ``ntile``)."""
    q = F.floor(m / n)
    r = m - q * n
    big = r * (q + 1)
    return F.when(idx < big, F.floor(idx / (q + 1)) + 1).otherwise(r + F.floor(F.try_divide(idx - big, q)) + 1).cast("int")
