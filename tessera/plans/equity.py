"""Equity-signal jobs D7-D12: special-status timeline, return panel,
accounting-ratio growth signal, single-sort portfolios, high-minus-low
spread and factor alphas.

Column conventions: entity (stock id), y, m (calendar year and month).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.scalar import make_day, rebalance_year, recode, yyyymm
from tessera.operators import ordered as O
from tessera.operators.frame import first_per_key
from tessera.operators.stats import ols_multi_by

# fixed values: notice change codes that move a stock out of / back into the normal state
STATUS_CODES = {
    "out": ["AB", "AD", "AX", "BC", "BD", "BX", "CB", "CX", "DB", "DX"],
    "in": ["BA", "DA", "CA"],
}


def status_timeline(panel: DataFrame, notices: DataFrame,
                    codes: Mapping[str, Sequence[str]] = STATUS_CODES, default: str = "in") -> DataFrame:
    """Monthly effective status per stock.

    Notices get a status from their change code and a (y, m) from their date;
    stock-months left-join the notices; each stock's first row is forced to
    ``default``; the status is forward filled; ``decision`` is the previous
    row's filled status (``default`` on the first row), so a change acts the
    month after its notice. Several notices in a month are ordered by notice
    date then id, and one row per stock-month is kept (the first).

    ``panel``: (entity, y, m); ``notices``: (notice_id, entity, notice_date, chgtype).
    """
    n = notices.select("notice_id", "entity", "notice_date",
                       F.year("notice_date").cast("int").alias("y"), F.month("notice_date").cast("int").alias("m"),
                       recode("chgtype", codes).alias("status"))
    j = panel.select("entity", "y", "m").join(n, ["entity", "y", "m"], "left")
    order = ["y", "m", "notice_date", "notice_id"]
    s = O.status_effective(j, "entity", order, "status", default=default, out="decision")
    return first_per_key(s, ["entity", "y", "m"], ["notice_date", "notice_id"]).select(
        "entity", "y", "m", "status_filled", "decision")


def return_panel(df: DataFrame, year_range: tuple[int, int] | None = None, where: Column | None = None,
                 mv: str = "mv", tmv: str | None = None) -> DataFrame:
    """Monthly return panel with sample filters applied first (year range,
    extra predicate, non-missing ``ret`` and ``mv``), then previous-row market
    values per stock (``mvlag``, ``tmvlag``), the day-28 date and the
    portfolio year (May to April). Input: (entity, y, m, ret, mv[, tmv])."""
    d = df.where(F.col("ret").isNotNull() & F.col(mv).isNotNull())
    if year_range:
        d = d.where(F.col("y").between(*year_range))
    if where is not None:
        d = d.where(where)
    specs = [(mv, 1, "mvlag")] + ([(tmv, 1, "tmvlag")] if tmv else [])
    d = O.lags(d, "entity", ["y", "m"], specs)
    return d.withColumns({"date": make_day("y", "m", 28), "yearr": rebalance_year("y", "m")})


def ratio_growth(stmt: DataFrame, floor: float = 10_000_000, base: str = "later") -> DataFrame:
    """Growth of the spend / cap ratio from the two previous year-ends.

    Drop month 1; drop spend at or below ``floor`` (missing too); ratio =
    spend / cap; keep month 12; l1, l2 = previous one and two rows per firm
    (after the filters); drop rows missing either; g = (l1 - l2) / l1.
    Input: (entity, y, m, spend, cap)."""
    d = stmt.where(F.col("m") != 1).where(F.col("spend") > floor)
    d = d.withColumn("ratio", F.try_divide(F.col("spend").cast("double"), F.col("cap").cast("double")))
    d = d.where(F.col("m") == 12)
    d = O.lagged_growth(d, "entity", "y", "ratio", base=base, out="g")
    return (d.where(F.col("ratio_l1").isNotNull() & F.col("ratio_l2").isNotNull())
            .select("entity", "y", "ratio", F.col("ratio_l1").alias("l1"), F.col("ratio_l2").alias("l2"), "g"))


def single_sort(df: DataFrame, group: str, lo: int, hi: int, ret: str = "ret", weight: str = "mvlag",
                where: Column | None = None) -> DataFrame:
    """Equal- and value-weighted portfolio returns per group and month
    within ``lo <= y*100+m <= hi``: ew = mean return, vw = sum(ret * w) /
    sum(w) over rows with both present, n = rows. One aggregation.
    ``where`` is an explicit sample filter, e.g. ``F.col("decision") == "in"``
    to leave out stocks under special treatment (from ``status_timeline``)."""
    d = df.where(yyyymm("y", "m").between(lo, hi) & F.col(group).isNotNull())
    if where is not None:
        d = d.where(where)
    both = F.col(ret).isNotNull() & F.col(weight).isNotNull()
    return d.groupBy(F.col(group).cast("string").alias("grp"), "y", "m").agg(
        F.avg(ret).alias("ew"),
        F.try_divide(F.sum(F.when(both, F.col(ret) * F.col(weight))), F.sum(F.when(both, F.col(weight)))).alias("vw"),
        F.count(F.lit(1)).cast("bigint").alias("n"))


def high_low(port: DataFrame, hi: str = "10", lo: str = "1", label: str = "H-L") -> DataFrame:
    """Per month, top group minus bottom group for ew and vw; months
    lacking either side are dropped."""
    g = port.where(F.col("grp").isin(hi, lo)).groupBy("y", "m").agg(
        F.max(F.when(F.col("grp") == hi, F.col("ew"))).alias("_hew"),
        F.max(F.when(F.col("grp") == lo, F.col("ew"))).alias("_lew"),
        F.max(F.when(F.col("grp") == hi, F.col("vw"))).alias("_hvw"),
        F.max(F.when(F.col("grp") == lo, F.col("vw"))).alias("_lvw"),
        F.count_if(F.col("grp") == hi).alias("_nh"), F.count_if(F.col("grp") == lo).alias("_nl"))
    return g.where((F.col("_nh") > 0) & (F.col("_nl") > 0)).select(
        F.lit(label).alias("grp"), "y", "m", (F.col("_hew") - F.col("_lew")).alias("ew"),
        (F.col("_hvw") - F.col("_lvw")).alias("vw"))


def within(port: DataFrame, window: tuple[int | None, int | None] | None) -> DataFrame:
    """Rows from a begin to an end month (``y * 100 + m``, both included);
    None leaves that side open."""
    begin, end = window or (None, None)
    at = yyyymm("y", "m")
    if begin is not None:
        port = port.where(at >= begin)
    return port if end is None else port.where(at <= end)


Window = tuple[int | None, int | None] | None


def raw_returns(port: DataFrame, weight: str = "ew", window: Window = None) -> DataFrame:
    """D12 (raw): mean portfolio return per group with its t statistic
    t = mean / (sd / sqrt(n)), over the months ``within`` the window."""
    r = F.col(weight)
    g = within(port, window).groupBy("grp").agg(F.avg(r).alias("mean"), F.stddev_samp(r).alias("sd"),
                                F.count(r).cast("bigint").alias("n"))
    return g.withColumn("t", F.try_divide(F.col("mean"), F.col("sd") / F.sqrt(F.col("n"))))


def capm_alpha(port: DataFrame, factors: DataFrame, weight: str = "ew", spread_label: str = "H-L",
               window: Window = None) -> DataFrame:
    """D12 (CAPM): per group regress excess return (ret - rf; not for the
    spread portfolio) on ``mkt``: alpha, beta, t of alpha, R^2, n, over the
    months ``within`` the window."""
    j = within(port, window).join(factors, ["y", "m"])
    ex = F.when(F.col("grp") == spread_label, F.col(weight)).otherwise(F.col(weight) - F.col("rf"))
    d = j.select("grp", ex.alias("yv"), F.col("mkt").alias("xv")).where(F.col("yv").isNotNull() & F.col("xv").isNotNull())
    g = d.groupBy("grp").agg(
        F.regr_intercept("yv", "xv").alias("alpha"), F.regr_slope("yv", "xv").alias("beta"),
        F.regr_r2("yv", "xv").alias("r2"), F.regr_count("yv", "xv").cast("bigint").alias("n"),
        F.regr_sxx("yv", "xv").alias("_sxx"), F.regr_syy("yv", "xv").alias("_syy"),
        F.regr_sxy("yv", "xv").alias("_sxy"), F.avg("xv").alias("_mx"))
    s2 = (F.col("_syy") - F.try_divide(F.col("_sxy") * F.col("_sxy"), F.col("_sxx"))) / (F.col("n") - 2)
    se = F.sqrt(s2 * (1.0 / F.col("n") + F.try_divide(F.col("_mx") * F.col("_mx"), F.col("_sxx"))))
    return g.withColumn("t_alpha", F.when(F.col("n") > 2, F.try_divide(F.col("alpha"), se))).drop(
        "_sxx", "_syy", "_sxy", "_mx")


def ff3_alpha(port: DataFrame, factors: DataFrame, weight: str = "ew", spread_label: str = "H-L",
              window: Window = None) -> DataFrame:
    """D12 (three factors): per group regress excess return on mkt, smb, hml
    (grouped sufficient statistics, solved per group), over the months
    ``within`` the window."""
    j = within(port, window).join(factors, ["y", "m"])
    ex = F.when(F.col("grp") == spread_label, F.col(weight)).otherwise(F.col(weight) - F.col("rf"))
    return ols_multi_by(j.withColumn("ex_ret", ex), ["grp"], "ex_ret", ["mkt", "smb", "hml"])


def factor_alphas(port: DataFrame, factors: DataFrame, weight: str = "ew", model: str = "capm",
                  window: Window = None) -> DataFrame:
    """Portfolio performance per group for ``weight`` in ("ew", "vw"):
    ``model="raw"`` mean return and t; ``"capm"`` alpha and beta on the market
    excess return; ``"ff3"`` alpha and loadings on mkt, smb, hml; ``window``
    gives the begin and end month."""
    if model == "raw":
        return raw_returns(port, weight, window=window)
    if model == "capm":
        return capm_alpha(port, factors, weight, window=window)
    if model == "ff3":
        return ff3_alpha(port, factors, weight, window=window)
    raise ValueError(f"model must be raw, capm or ff3, not {model!r}")
