"""Fund tracking-precision jobs D13-D21.

Inputs (fixture column names):
  returns(fund_text, d, fund_return_pct)  daily fund returns in percent
  navs(fund_text, d, nav)                 daily net asset values
  universe(code)                          funds to keep
  index(code, y, m, idx_return)           monthly target-index return per fund
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.scalar import abs_diff, flow_ratio, to_number
from tessera.operators import ordered as O
from tessera.operators.joins import flag_match, restrict_to
from tessera.operators.stats import beta_gap, corr_matrix


def fund_nav_panel(returns: DataFrame, navs: DataFrame, universe: DataFrame, reset: bool = True) -> DataFrame:
    """Daily fund / NAV panel.

    returns left-join navs on (fund, day); rows without NAV dropped; numeric
    code; nav_return = ln(nav / previous nav); restricted to the universe;
    fund_return = pct / 100 and its previous-row value; tracking error =
    previous fund return - nav return. Lags are per fund (``reset=False``
    reproduces a lag that runs on across funds in (code, day) order)."""
    j = (returns.join(navs, ["fund_text", "d"], "left").where(F.col("nav").isNotNull())
         .withColumns({"code": to_number("fund_text"), "fund_return": F.col("fund_return_pct") / 100})
         .drop("fund_text"))
    if reset:
        # per-fund lags do not depend on which other funds are present, so both
        # lags run in one pass before the (whole-fund) universe restriction
        j = O.lags(j, "code", "d", [("nav", 1, "nav_lag"), ("fund_return", 1, "fund_return_lag")])
        j = restrict_to(j, universe, ["code"])
    else:
        # a lag that runs on across funds sees the table as it is at each step
        j = O.lag_by(j, "code", "d", "nav", out="nav_lag", reset=False)
        j = restrict_to(j, universe, ["code"])
        j = O.lag_by(j, "code", "d", "fund_return", out="fund_return_lag", reset=False)
    j = j.withColumn("nav_return", F.when(F.try_divide(F.col("nav"), F.col("nav_lag")) > 0,
                                          F.ln(F.try_divide(F.col("nav"), F.col("nav_lag")))))
    return j.select("code", "d", F.year("d").cast("int").alias("y"), F.month("d").cast("int").alias("m"),
                    "nav", "nav_lag", "nav_return", "fund_return", "fund_return_lag",
                    (F.col("fund_return_lag") - F.col("nav_return")).alias("tracking_error"))


def monthly_gaps(panel: DataFrame, index: DataFrame, index_scale: float = 30.0) -> DataFrame:
    """Month means of NAV and (lagged) fund returns over all funds, the
    month mean index return divided by ``index_scale``, and absolute gaps."""
    fm = panel.groupBy("y", "m").agg(F.avg("nav_return").alias("monthly_nav_return"),
                                     F.avg("fund_return_lag").alias("monthly_fund_return"))
    im = index.groupBy("y", "m").agg((F.avg("idx_return") / index_scale).alias("monthly_index_adj"))
    j = fm.join(im, ["y", "m"])
    return j.withColumns({"fund_nav": abs_diff("monthly_fund_return", "monthly_nav_return"),
                          "nav_index": abs_diff("monthly_nav_return", "monthly_index_adj")})


def average_liquidity(liq: DataFrame, universe: DataFrame, scale: float = 10000.0) -> DataFrame:
    """Month mean of abs(liquidity value) over universe funds, / ``scale``.
    ``liq``: (code, y, m, c)."""
    u = restrict_to(liq, universe, ["code"])
    return u.groupBy("y", "m").agg((F.avg(F.abs("c")) / scale).alias("average_liquidity"))


def liquidity_join(gaps: DataFrame, liq: DataFrame, universe: DataFrame) -> DataFrame:
    """Monthly gaps left-joined with the average liquidity of the month."""
    return gaps.select("y", "m", "fund_nav", "nav_index").join(average_liquidity(liq, universe), ["y", "m"], "left")


def yearly_returns(panel: DataFrame, index_monthly: DataFrame, fund_index: DataFrame) -> DataFrame:
    """Per (fund, year) sums of daily NAV returns and lagged fund
    returns, joined with the yearly return of the fund's target index.
    ``fund_index``: (code, index_code) pairs (deduplicated here);
    ``index_monthly``: (index_code, y, m, idx_return) summed to years."""
    fy = panel.groupBy("code", "y").agg(F.sum("nav_return").alias("yearly_nav_return"),
                                        F.sum("fund_return_lag").alias("yearly_fund_return"))
    iy = index_monthly.groupBy("index_code", "y").agg(F.sum("idx_return").alias("idx_return"))
    pairs = fund_index.select("code", "index_code").distinct()
    return fy.join(pairs, "code").join(iy, ["index_code", "y"])


def _slope_gap(y: str, x: str):
    """abs(1 - slope) of the simple regression y ~ x (rows with both present)."""
    return beta_gap(F.regr_slope(F.col(y).cast("double"), F.col(x).cast("double")))


def tracking_error(yearly: DataFrame) -> DataFrame:
    """Two tracking-error measures per fund: abs(1 - slope) of the
    fund~index, fund~nav and nav~index regressions, and the sample std of the
    three signed yearly differences -- all six in one grouped aggregation
    (one pass over the yearly table, no joins between the measures)."""
    return yearly.groupBy("code").agg(
        _slope_gap("yearly_fund_return", "idx_return").alias("coef_gap_fund_index"),
        _slope_gap("yearly_fund_return", "yearly_nav_return").alias("coef_gap_fund_nav"),
        _slope_gap("yearly_nav_return", "idx_return").alias("coef_gap_nav_index"),
        F.stddev_samp(F.col("yearly_fund_return") - F.col("idx_return")).alias("fund_index_std"),
        F.stddev_samp(F.col("yearly_fund_return") - F.col("yearly_nav_return")).alias("fund_nav_std"),
        F.stddev_samp(F.col("yearly_nav_return") - F.col("idx_return")).alias("nav_index_std"))


TE_COLUMNS = ["coef_gap_fund_index", "coef_gap_nav_index", "coef_gap_fund_nav",
              "fund_index_std", "nav_index_std", "fund_nav_std"]


def method_corr(te: DataFrame) -> DataFrame:
    """6 x 6 correlation matrix of the two methods' measures."""
    return corr_matrix(te, TE_COLUMNS).select("var", "with_var", "r", "n")


def factor_flags(liq: DataFrame, cash: DataFrame, dividends: DataFrame, shares: DataFrame,
                 threshold: float = 0.1) -> DataFrame:
    """Per fund-month factors.

    Base rows: fund-months with a liquidity value and a monthly cash-difference
    sum (inner). ``dum2`` = 1 when a dividend was paid that month. Share
    change ratio = abs(purchases - redemptions) / opening shares (missing
    flows 0); ``dum1`` = ratio >= threshold (unknown -> 0); left-joined, then
    forward filled per fund (the first row keeps its own value).
    liq (code, y, m, c); cash (code, y, m, cashdiffer); dividends (code, y, m);
    shares (code, y, m, purchase, redemption, opening)."""
    base = (liq.select("code", "y", "m", F.abs("c").alias("liquidity_value"))
            .join(cash.groupBy("code", "y", "m").agg(F.sum("cashdiffer").alias("monthly_cashdiffer")),
                  ["code", "y", "m"]))
    base = flag_match(base, dividends.select("code", "y", "m"), ["code", "y", "m"], "dum2")
    ratio = flow_ratio("purchase", "redemption", "opening")
    d1 = shares.select("code", "y", "m", F.when(ratio >= threshold, 1).otherwise(0).alias("dum1"))
    j = base.join(d1, ["code", "y", "m"], "left")
    return O.ffill(j, "code", ["y", "m"], "dum1", out="dum1_filled")


def _monthly_sums(panel: DataFrame) -> DataFrame:
    return panel.groupBy("code", "y", "m").agg(F.sum("nav_return").alias("monthly_nav_return"),
                                               F.sum("fund_return_lag").alias("monthly_fund_return"))


def _one_index(index: DataFrame) -> DataFrame:
    # one index return per fund-month (first by value, then deterministic)
    return index.groupBy("code", "y", "m").agg(F.min("idx_return").alias("idx_return"))


def factor_panel(panel: DataFrame, index: DataFrame, flags: DataFrame) -> DataFrame:
    """Per fund-month absolute gaps (fund-index, fund-nav, nav-index)
    joined with the factor flags."""
    j = _monthly_sums(panel).join(_one_index(index), ["code", "y", "m"])
    gaps = j.select("code", "y", "m",
                    abs_diff("monthly_fund_return", "idx_return").alias("fund_index"),
                    abs_diff("monthly_fund_return", "monthly_nav_return").alias("fund_nav"),
                    abs_diff("monthly_nav_return", "idx_return").alias("nav_index"))
    return gaps.join(flags.select("code", "y", "m", "liquidity_value", "monthly_cashdiffer",
                                  F.col("dum1_filled").alias("dum1"), "dum2"), ["code", "y", "m"])


def cross_section_gaps(panel: DataFrame, index: DataFrame, liq: DataFrame, universe: DataFrame) -> DataFrame:
    """Per month, three regressions across funds (fund~index,
    fund~nav, nav~index), abs(1 - slope) each -- one grouped aggregation --
    then the month's average liquidity (inner)."""
    j = _monthly_sums(panel).join(_one_index(index), ["code", "y", "m"])
    gaps = j.groupBy("y", "m").agg(
        _slope_gap("monthly_fund_return", "idx_return").alias("coef_gap_fund_index"),
        _slope_gap("monthly_fund_return", "monthly_nav_return").alias("coef_gap_fund_nav"),
        _slope_gap("monthly_nav_return", "idx_return").alias("coef_gap_nav_index"))
    return gaps.join(average_liquidity(liq, universe), ["y", "m"])


def fund_month_differences(panel: DataFrame, index: DataFrame) -> DataFrame:
    """D21 (second table): fund-month absolute return differences."""
    j = _monthly_sums(panel).join(_one_index(index), ["code", "y", "m"])
    return j.select("code", "y", "m",
                    abs_diff("monthly_fund_return", "monthly_nav_return").alias("fund_nav_difference"),
                    abs_diff("monthly_fund_return", "idx_return").alias("fund_index_difference"),
                    abs_diff("monthly_nav_return", "idx_return").alias("nav_index_difference"))
