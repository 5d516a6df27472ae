"""Aggregation and description A1-A20.

All grouped operators are single hash aggregations (partial aggregation on
the map side, so a key holding a third of the rows is pre-reduced in every
task before the shuffle). Exact quantiles are selected between bounds of
sketches by exact counts (``rank.quantiles``), so no task holds a whole group's values; pass
``accuracy=`` to use the ``percentile_approx`` sketch instead.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _keys_not_null(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    cond = None
    for k in keys:
        e = F.col(k).isNotNull()
        cond = e if cond is None else cond & e
    return df.where(cond) if cond is not None else df


def sum_by(df: DataFrame, keys: Sequence[str], cols: Sequence[str], nulls: str = "pandas",
           suffix: str = "") -> DataFrame:
    """A1/A2: grouped sums.

    ``nulls="pandas"``: rows with a missing key are dropped and an all-missing
    sum is 0. ``nulls="sql"``: missing keys form their own group, all-missing
    sums stay NULL.
    """
    keys = list(keys)
    src = _keys_not_null(df, keys) if nulls == "pandas" else df
    aggs = []
    for c in cols:
        s = F.sum(F.col(c))
        if nulls == "pandas":
            s = F.coalesce(s, F.lit(0))
        aggs.append(s.alias(c + suffix))
    return src.groupBy(*keys).agg(*aggs)


def mean_by(df: DataFrame, keys: Sequence[str], cols: Sequence[str], scale: float | None = None,
            suffix: str = "") -> DataFrame:
    """A3: grouped means of non-missing values, optionally divided by ``scale``."""
    aggs = []
    for c in cols:
        m = F.avg(F.col(c))
        if scale:
            m = m / F.lit(float(scale))
        aggs.append(m.alias(c + suffix))
    return df.groupBy(*keys).agg(*aggs)


def std_by(df: DataFrame, keys: Sequence[str], col: str, out: str | None = None) -> DataFrame:
    """A4: sample standard deviation per group; missing class values form a
    group of their own (PROC SUMMARY with MISSING). n = 1 gives NULL."""
    return df.groupBy(*keys).agg(F.stddev_samp(col).alias(out or f"std_{col}"),
                                 F.count(col).cast("bigint").alias("n"))


def count_by(df: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """A5: non-missing count per column and group (pandas ``count``)."""
    keys = list(keys)
    return _keys_not_null(df, keys).groupBy(*keys).agg(
        *[F.count(F.col(c)).cast("bigint").alias(c) for c in cols])


def first_minus_last(df: DataFrame, keys: Sequence[str], value: str, order: str,
                     out: str = "delta") -> DataFrame:
    """Value at the earliest ``order`` minus value at the latest, per group.

    Missing values are dropped first (engines differ on NULL in ``max_by``).
    One hash aggregation with ``min_by``/``max_by`` (map-side combined); no
    sort of the group is needed.
    """
    keys = list(keys)
    return (df.where(F.col(value).isNotNull())
            .groupBy(*keys)
            .agg((F.min_by(value, order) - F.max_by(value, order)).alias(out)))


def rollup_units(df: DataFrame, unit_keys: Sequence[str], site_keys: Sequence[str], value: str,
                 order: str, out: str = "delta") -> DataFrame:
    """First-minus-last per unit, then summed to the site (two levels).
    ``site_keys`` must be a subset of ``unit_keys``."""
    units = first_minus_last(df, unit_keys, value, order, out)
    return sum_by(units, site_keys, [out], nulls="pandas")


def avg_per_period(df: DataFrame, key: Sequence[str], value: str, period: str,
                   out: str = "avg_per_period", digits: int | None = 0) -> DataFrame:
    """Total per key divided by the largest period number in the whole
    table (not per key), rounded half-to-even. The divisor is a scalar
    subquery (one number), not a join."""
    key = list(key)
    n_periods = df.select(F.max(F.col(period))).scalar()
    total = F.sum(F.col(value))
    avg = total / n_periods
    if digits is not None:
        avg = F.bround(avg, digits)
    return _keys_not_null(df, key).groupBy(*key).agg(avg.alias(out))


def band_share(df: DataFrame, group: Sequence[str], category: str, band: str,
               bands: Sequence | None = None, out: str = "percent") -> DataFrame:
    """Percent of rows of each band within (group, category).

    With ``bands`` given, every band appears for every (group, category)
    present, 0 when empty."""
    gk = list(group) + [category]
    counts = df.groupBy(*gk, band).agg(F.count(F.lit(1)).alias("_n"))
    tot = df.groupBy(*gk).agg(F.count(F.lit(1)).alias("_tot"))
    if bands is not None:
        levels = F.explode(F.array(*[F.lit(b) for b in bands])).alias(band)
        grid = tot.select(*gk, "_tot", levels)
        j = grid.join(counts, gk + [band], "left")
        return j.select(*gk, band, (F.coalesce(F.col("_n"), F.lit(0)) * 100.0 / F.col("_tot")).alias(out))
    w = Window.partitionBy(*gk)
    return counts.select(*gk, band, (F.col("_n") * 100.0 / F.sum("_n").over(w)).alias(out))


def proportions(df: DataFrame, parts: Sequence[str], total: str, suffix: str = "_share") -> DataFrame:
    """A10: each part divided by the total; total 0 or missing -> NULL."""
    return df.withColumns({p + suffix: F.try_divide(F.col(p).cast("double"), F.col(total).cast("double"))
                           for p in parts})


def value_counts(df: DataFrame, c: str) -> DataFrame:
    """Counts of each non-missing value, most frequent first."""
    return (df.where(F.col(c).isNotNull()).groupBy(c)
            .agg(F.count(F.lit(1)).cast("bigint").alias("count"))
            .orderBy(F.col("count").desc(), F.col(c)))


def null_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Per column, number of missing values and whether any is missing.
    One pass over the data (one ``count_if`` per column), then a 1-row unpivot.
    NaN counts as missing, as in pandas."""
    cols = list(cols or df.columns)
    dtypes = dict(df.dtypes)

    def missing(c: str) -> Column:
        m = F.col(c).isNull()
        if dtypes[c] in ("double", "float"):
            m = m | F.isnan(F.col(c))
        return m

    one = df.agg(*[F.count_if(missing(c)).cast("bigint").alias(c) for c in cols])
    long = one.unpivot([], cols, "column_name", "n_missing")
    return long.withColumn("any_missing", F.col("n_missing") > 0)


def null_patterns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row per pattern of missing columns with its row count
    (the numbers behind a missing-value matrix picture)."""
    flags = [F.col(c).isNull().cast("int").alias(f"{c}_missing") for c in cols]
    return df.groupBy(*flags).agg(F.count(F.lit(1)).cast("bigint").alias("n"))


def _q(c: Column, q, accuracy: int | None) -> Column:
    if accuracy:
        return F.percentile_approx(c, q, accuracy)
    return F.percentile(c, q)


def summary(df: DataFrame, cols: Sequence[str], accuracy: int | None = None) -> DataFrame:
    """Per numeric column min, Q1, median, mean, Q3, max and number
    missing (R ``summary``; quantiles type 7 = linear interpolation).

    The columns are stacked into (column_name, value) pairs (a narrow
    ``unpivot``), so one grouped aggregation gives the moments of every column
    and one run of the exact distributed quantiles (``rank.quantiles``, by
    column name) gives every quartile. ``accuracy`` switches the quartiles to
    the ``percentile_approx`` sketch."""
    from tessera.operators.rank import quantiles

    long = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).unpivot([], list(cols), "column_name", "value")
    v = F.col("value")
    mom = long.groupBy("column_name").agg(
        F.min(v).alias("min"), F.avg(v).alias("mean"), F.max(v).alias("max"),
        F.count_if(v.isNull()).cast("bigint").alias("n_missing"),
        *([_q(v, 0.25, accuracy).alias("q1"), _q(v, 0.5, accuracy).alias("median"),
           _q(v, 0.75, accuracy).alias("q3")] if accuracy else []))
    if not accuracy:
        q = quantiles(long, "value", [0.25, 0.5, 0.75], by=["column_name"], names=["q1", "median", "q3"])
        mom = mom.join(q, "column_name", "left")
    return mom.select("column_name", "min", "q1", "median", "mean", "q3", "max", "n_missing")


def box_stats(df: DataFrame, keys: Sequence[str], value: str, accuracy: int | None = None) -> DataFrame:
    """Box-plot numbers per group: quartiles, whiskers at the last data
    point inside 1.5 IQR of the box, and the count of points outside.

    Exact quartiles per group (``rank.quantiles``, one row per group), joined back to the rows, then conditional min/max/count.
    """
    from tessera.operators.rank import quantiles

    keys = list(keys)
    v = F.col(value)
    base = df.where(v.isNotNull())
    if accuracy:
        q = base.groupBy(*keys).agg(_q(v, 0.25, accuracy).alias("q1"), _q(v, 0.5, accuracy).alias("median"),
                                    _q(v, 0.75, accuracy).alias("q3"))
    else:
        q = quantiles(base, value, [0.25, 0.5, 0.75], by=keys, names=["q1", "median", "q3"])
    q = q.withColumns({"lo_fence": F.col("q1") - 1.5 * (F.col("q3") - F.col("q1")),
                       "hi_fence": F.col("q3") + 1.5 * (F.col("q3") - F.col("q1"))})
    j = base.join(q, keys, "inner")
    inside = (v >= F.col("lo_fence")) & (v <= F.col("hi_fence"))
    return j.groupBy(*keys, "q1", "median", "q3").agg(
        F.min(F.when(inside, v)).alias("whisker_lo"),
        F.max(F.when(inside, v)).alias("whisker_hi"),
        F.count_if(~inside).cast("bigint").alias("n_outliers"),
        F.count(F.lit(1)).cast("bigint").alias("n"))


def bucket(v: Column, lo, hi, bins: int) -> Column:
    """0-based equal-width bin of v in [lo, hi]; v == hi folds into the last
    bin; outside -> NULL. Computed as floor(bins * (v - lo) / (hi - lo))."""
    lo_c, hi_c = F.lit(lo).cast("double") if not isinstance(lo, Column) else lo, \
        F.lit(hi).cast("double") if not isinstance(hi, Column) else hi
    raw = F.floor(F.lit(bins) * (v - lo_c) / (hi_c - lo_c)).cast("int")
    return (F.when((v < lo_c) | (v > hi_c) | v.isNull(), F.lit(None).cast("int"))
            .when(v == hi_c, F.lit(bins - 1)).otherwise(F.least(raw, F.lit(bins - 1))))


def histogram(df: DataFrame, c: str, bins: int, lo: float, hi: float) -> DataFrame:
    """Equal-width histogram in one pass; every bin present (0 if empty).
    Output: bin (1..bins), lo, hi, count."""
    spark = df.sparkSession
    counts = (df.select(bucket(F.col(c).cast("double"), lo, hi, bins).alias("_b"))
              .where(F.col("_b").isNotNull()).groupBy("_b").agg(F.count(F.lit(1)).alias("_n")))
    width = (hi - lo) / bins
    grid = spark.range(bins).select(F.col("id").cast("int").alias("_b"))
    return (grid.join(counts, "_b", "left")
            .select((F.col("_b") + 1).alias("bin"),
                    (F.lit(lo) + F.col("_b") * F.lit(width)).alias("bin_lo"),
                    (F.lit(lo) + (F.col("_b") + 1) * F.lit(width)).alias("bin_hi"),
                    F.coalesce(F.col("_n"), F.lit(0)).cast("bigint").alias("count")))


def histogram2d(df: DataFrame, x: str, y: str, bins: int = 12) -> DataFrame:
    """2-D equal-width histogram over the data range of x and y (ranges
    are scalar subqueries); all bins x bins cells present."""
    spark = df.sparkSession
    xv, yv = F.col(x).cast("double"), F.col(y).cast("double")
    src = df.where(xv.isNotNull() & yv.isNotNull())
    lim = src.agg(F.min(xv).alias("x0"), F.max(xv).alias("x1"), F.min(yv).alias("y0"), F.max(yv).alias("y1"))
    x0, x1 = lim.select("x0").scalar(), lim.select("x1").scalar()
    y0, y1 = lim.select("y0").scalar(), lim.select("y1").scalar()
    counts = (src.select(bucket(xv, x0, x1, bins).alias("xbin"), bucket(yv, y0, y1, bins).alias("ybin"))
              .groupBy("xbin", "ybin").agg(F.count(F.lit(1)).alias("_n")))
    grid = (spark.range(bins * bins)
            .select((F.col("id") / bins).cast("int").alias("xbin"), (F.col("id") % bins).cast("int").alias("ybin")))
    return (grid.join(counts, ["xbin", "ybin"], "left")
            .select((F.col("xbin") + 1).alias("xbin"), (F.col("ybin") + 1).alias("ybin"),
                    F.coalesce(F.col("_n"), F.lit(0)).cast("bigint").alias("count")))


def distinct_values(df: DataFrame, c: str) -> DataFrame:
    """The distinct values of a column (missing included, as ``unique``)."""
    return df.select(c).distinct()


def shape(df: DataFrame) -> DataFrame:
    """Number of rows and columns, as a one-row table."""
    return df.agg(F.count(F.lit(1)).cast("bigint").alias("n_rows")).withColumn(
        "n_cols", F.lit(len(df.columns)).cast("bigint"))


def score_summary(df: DataFrame, c: str, keys: Sequence[str] = ()) -> DataFrame:
    """Mean and population standard deviation (numpy ``std``) of scores."""
    return df.groupBy(*keys).agg(F.avg(c).alias("mean"), F.stddev_pop(c).alias("std_pop"),
                                 F.count(c).cast("bigint").alias("n"))


