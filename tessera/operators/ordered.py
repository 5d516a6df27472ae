"""Windows and ordered time series W1-W13.

Lags, fills and status (W1-W9) are one segmented scan (``scan``) at every size:
ranges of (entity, order), each of about the same number of rows, with small
states carried from range to range, so an entity that holds a large share of
all rows is spread like any other. ``ranges`` sets the number of parts.
Where a per-entity result can be had from a hash aggregation instead of a
sort (first-row flag, period numbers), that form is used.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.joins import null_safe_join
from tessera.operators.scan import Fill, Lag, segmented


def _list(x) -> list:
    return [x] if isinstance(x, (str, Column)) else list(x)


def lags(df: DataFrame, entity, order, specs: Sequence[tuple[str, int, str]], ranges: int | None = None) -> DataFrame:
    """Several lags ``(column, n, out)`` within entity in one scan."""
    return segmented(df, _list(entity), _list(order), [Lag(c, n, out) for c, n, out in specs], ranges=ranges)


def lag_by(df: DataFrame, entity, order, c: str, n: int = 1, out: str | None = None,
           reset: bool = True, where: Column | None = None, when: str = "before", ranges: int | None = None) -> DataFrame:
    """Previous-row value of ``c`` within each entity.

    * ``n``: how many rows back (W2: the lag of a lag reset at the first row
      equals ``n=2``).
    * ``reset=False`` (W3): dataset-order lag over the table sorted by
      (entity, order) with no reset at entity boundaries, so the first row of
      an entity takes the previous entity's last value.
    * ``where`` with ``when="before"`` filters first, then lags (SAS WHERE or a
      subsetting IF before LAG); ``when="after"`` lags on all rows, then filters.
    """
    src = df.where(where) if (where is not None and when == "before") else df
    res = segmented(src, _list(entity), _list(order), [Lag(c, n, out or f"{c}_lag{n}", reset)], ranges=ranges)
    return res.where(where) if where is not None and when == "after" else res


def ffill(df: DataFrame, entity, order, c: str, first=None, out: str | None = None, ranges: int | None = None) -> DataFrame:
    """Forward fill of ``c`` within each entity.

    With ``first`` given (W4) the first row of each entity is forced to that
    value before filling, even when the row has its own value. Without it
    (W5) the first row keeps its own value, maybe missing.
    """
    return segmented(df, _list(entity), _list(order), fills=[Fill(c, out or f"{c}_filled", first)], ranges=ranges)


def status_effective(df: DataFrame, entity, order, c: str, default="in",
                     out: str = "decision", ranges: int | None = None) -> DataFrame:
    """Status that takes effect the period after a notice: forward fill
    with the first row forced to ``default``, then the previous row's filled
    value; the first row gets ``default``."""
    f = segmented(df, _list(entity), _list(order), fills=[Fill(c, f"{c}_filled", default, before=out)], ranges=ranges)
    return f.withColumn(out, F.coalesce(F.col(out), F.lit(default)))


def log_return(df: DataFrame, entity, order, c: str, out: str | None = None, ranges: int | None = None) -> DataFrame:
    """ln(c / previous c) within entity; non-positive ratio or missing -> NULL."""
    d = lag_by(df, entity, order, c, out="_prev", ranges=ranges)
    ratio = F.try_divide(F.col(c).cast("double"), F.col("_prev").cast("double"))
    return d.withColumn(out or f"{c}_logret", F.when(ratio > 0, F.ln(ratio))).drop("_prev")


def lagged_growth(df: DataFrame, entity, order, c: str, base: str = "later",
                  out: str = "growth", ranges: int | None = None) -> DataFrame:
    """Growth from the two previous rows, ``(l1 - l2) / l1`` (as written,
    ``base="later"``) or ``(l1 - l2) / l2`` (``base="older"``)."""
    df = lags(df, entity, order, [(c, 1, f"{c}_l1"), (c, 2, f"{c}_l2")], ranges)
    l1, l2 = F.col(f"{c}_l1").cast("double"), F.col(f"{c}_l2").cast("double")
    return df.withColumn(out, F.try_divide(l1 - l2, l1 if base == "later" else l2))


def first_flag(df: DataFrame, entity, order, out: str = "first") -> DataFrame:
    """1 on the first row of each entity by ``order`` (unique within
    entity), else 0. The first key comes from a hash aggregation (map-side
    combined), joined back -- no per-entity sort."""
    entity, order = _list(entity), _list(order)
    ord_struct = F.struct(*[F.col(o) for o in order])
    firsts = df.groupBy(*entity).agg(F.min(ord_struct).alias("_first"))
    j = null_safe_join(df.withColumn("_k", ord_struct), firsts, entity, "left")
    return j.withColumn(out, F.col("_k").eqNullSafe(F.col("_first")).cast("int")).drop("_k", "_first")


def period_number(df: DataFrame, date: str, out: str = "date_number", by: str = "calendar",
                  position: str | None = None) -> DataFrame:
    """Number the distinct days 1, 2, ... and attach the number to rows.

    ``by="calendar"``: in date order. ``by="appearance"``: in order of first
    appearance, given a ``position`` column (e.g. file row number). The ranking
    runs on the table of distinct days only (bounded by the calendar span).
    """
    if by == "calendar":
        days = df.select(date).where(F.col(date).isNotNull()).distinct()
        ranked = days.select(date, F.dense_rank().over(Window.orderBy(date)).cast("int").alias(out))
    else:
        days = df.where(F.col(date).isNotNull()).groupBy(date).agg(F.min(position).alias("_pos"))
        ranked = days.select(date, F.row_number().over(Window.orderBy("_pos")).cast("int").alias(out))
    return df.join(ranked, date, "left")


def quantile_groups(df: DataFrame, by, c: str, n: int = 10, method: str = "ntile",
                    out: str = "grp", tiebreak: Sequence[str] = ()) -> DataFrame:
    """N groups of ``c`` within each period, 1 = lowest; missing ``c`` gets
    no group.

    ``method="ntile"``: as SQL ``ntile(n)`` over ``c`` then ``tiebreak`` (the
    first m mod n groups take one extra row). ``method="rank"``:
    ``floor(r * n / (m + 1)) + 1`` with r the average rank over ties and m the
    non-missing count of the period (PROC RANK GROUPS=n).

    Ranks come from distributed prefix sums (``rank.row_index`` /
    ``rank.prefix_sum``), not a window partitioned by period, so a period
    holding a third of the table is still ranked by many tasks.
    """
    from tessera.operators.rank import ntile_from_index, prefix_sum, row_index

    by = _list(by)
    v = F.col(c)
    have = df.where(v.isNotNull() & ~F.isnan(v.cast("double")))
    miss = df.where(v.isNull() | F.isnan(v.cast("double"))).withColumn(out, F.lit(None).cast("int"))
    counts = have.groupBy(*by).agg(F.count(F.lit(1)).alias("_m"))
    if method == "ntile":
        idx = row_index(have, [c, *tiebreak], by=by, out="_i")
        res = null_safe_join(idx, counts, by).withColumn(out, ntile_from_index(F.col("_i"), F.col("_m"), n)).drop("_i", "_m")
    else:
        ties = have.groupBy(*by, c).agg(F.count(F.lit(1)).alias("_t"))
        before = prefix_sum(ties, [c], "_t", by, out="_lt")
        r = F.col("_lt") + (F.col("_t") + 1) / 2.0
        grp = null_safe_join(before, counts, by).select(*by, c, (F.floor(r * n / (F.col("_m") + 1)) + 1).cast("int").alias(out))
        res = null_safe_join(have, grp, by + [c])
    return res.unionByName(miss)


def winsorize(df: DataFrame, by, c: str, p: float = 0.01, out: str | None = None,
              accuracy: int | None = None) -> DataFrame:
    """Clip ``c`` per period to its p and 1-p quantiles (exact, by
    selection; one row of bounds per period, joined back)."""
    from tessera.operators.rank import quantiles

    by = _list(by)
    if accuracy:
        q = F.percentile_approx(c, [p, 1 - p], accuracy)
        b = df.groupBy(*by).agg(q.alias("_q")).select(*by, F.col("_q")[0].alias("_lo"), F.col("_q")[1].alias("_hi"))
    else:
        b = quantiles(df, c, [p, 1 - p], by=by, names=["_lo", "_hi"])
    j = null_safe_join(df, b, by, "left")
    # least and greatest skip NULL: a missing value stays missing
    clipped = F.when(F.col(c).isNotNull(), F.least(F.greatest(F.col(c), F.col("_lo")), F.col("_hi")))
    return j.withColumn(out or f"{c}_w", clipped).drop("_lo", "_hi")
