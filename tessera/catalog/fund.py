"""Catalog: fund tracking-precision jobs D13-D21 (and J9-style index attach)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.catalog.common import T, V, W
from tessera.operators.reshape import complete_entities
from tessera.plans import fund as FD


def _inputs(spark, sf):
    nav = V(spark, sf, "v_nav_daily")
    returns = nav.select("fund_text", "d", "fund_return_pct")
    navs = nav.select("fund_text", "d", "nav")
    yearly = nav.select(F.col("fund_text").try_cast("bigint").alias("code"), F.year("d").alias("yr"))
    universe = complete_entities(yearly, ["code"], "yr").select("code").distinct()
    index = V(spark, sf, "v_index_monthly")
    return returns, navs, universe, index


def _panel(spark, sf, reset=True):
    returns, navs, universe, _ = _inputs(spark, sf)
    return FD.fund_nav_panel(returns, navs, universe, reset=reset)


def _liq(spark, sf):
    nav = V(spark, sf, "v_nav_daily")
    return (nav.groupBy(F.col("fund_text").try_cast("bigint").alias("code"), F.year("d").cast("int").alias("y"),
                        F.month("d").cast("int").alias("m")).agg(F.avg("nav").alias("c")))


def _flags(spark, sf):
    nav = V(spark, sf, "v_nav_daily")
    cash = nav.select(F.col("fund_text").try_cast("bigint").alias("code"), F.year("d").cast("int").alias("y"),
                      F.month("d").cast("int").alias("m"), F.col("fund_return_pct").alias("cashdiffer"))
    o = T(spark, sf, "orders").select((F.col("o_custkey") % 10).alias("code"), F.year("o_orderdate").cast("int").alias("y"),
                                      F.month("o_orderdate").cast("int").alias("m"), "o_orderstatus", "o_orderpriority",
                                      "o_totalprice")
    div = o.where(F.col("o_orderpriority") == "1-URGENT").select("code", "y", "m")
    shares = o.groupBy("code", "y", "m").agg(
        F.sum(F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice"))).alias("purchase"),
        F.sum(F.when(F.col("o_orderstatus") == "O", F.col("o_totalprice"))).alias("redemption"),
        F.sum("o_totalprice").alias("opening"))
    return FD.factor_flags(_liq(spark, sf), cash, div, shares)


def d13_fund_nav_panel(spark, sf):
    return _panel(spark, sf)


def d13_fund_nav_panel_no_reset(spark, sf):
    return _panel(spark, sf, reset=False).select("code", "d", "nav_lag", "fund_return_lag")


def d14_monthly_gaps(spark, sf):
    return FD.monthly_gaps(_panel(spark, sf), _inputs(spark, sf)[3])


def d15_liquidity_join(spark, sf):
    _, _, universe, index = _inputs(spark, sf)
    return FD.liquidity_join(FD.monthly_gaps(_panel(spark, sf), index), _liq(spark, sf), universe)


def _yearly(spark, sf):
    index = _inputs(spark, sf)[3]
    im = index.select(F.col("code").alias("index_code"), "y", "m", "idx_return")
    pairs = index.select("code", F.col("code").alias("index_code"))
    return FD.yearly_returns(_panel(spark, sf), im, pairs)


def d16_yearly_returns(spark, sf):
    return _yearly(spark, sf)


def d17_tracking_error(spark, sf):
    return FD.tracking_error(_yearly(spark, sf))


def d18_method_corr(spark, sf):
    return FD.method_corr(FD.tracking_error(_yearly(spark, sf)))


def d19_factor_flags(spark, sf):
    return _flags(spark, sf)


def d20_factor_panel(spark, sf):
    return FD.factor_panel(_panel(spark, sf), _inputs(spark, sf)[3], _flags(spark, sf))


def d21_cross_section_gaps(spark, sf):
    _, _, universe, index = _inputs(spark, sf)
    return FD.cross_section_gaps(_panel(spark, sf), index, _liq(spark, sf), universe)


def d21_fund_month_differences(spark, sf):
    return FD.fund_month_differences(_panel(spark, sf), _inputs(spark, sf)[3])


QUERIES = {k: v for k, v in globals().items() if k[:1] == "d" and k[1:2].isdigit() and callable(v)}

_PANEL = """u as (select code from (select cast(fund_text as bigint) as code, year(d) as yr from v_nav_daily) x
  group by code having count(distinct yr) = (select count(distinct year(d)) from v_nav_daily)),
j0 as (select cast(r.fund_text as bigint) as code, r.d, r.fund_return_pct, n.nav
  from v_nav_daily r left join v_nav_daily n on r.fund_text = n.fund_text and r.d = n.d where n.nav is not null),
j1 as (select *, lag(nav) over (partition by code order by d) as nav_lag from j0),
j2 as (select *, case when nav / nav_lag > 0 then ln(nav / nav_lag) end as nav_return, fund_return_pct / 100 as fund_return
  from j1 where code in (select code from u)),
j3 as (select *, lag(fund_return) over (partition by code order by d) as fund_return_lag from j2),
panel as (select code, d, cast(year(d) as int) as y, cast(month(d) as int) as m, nav, nav_lag, nav_return, fund_return,
  fund_return_lag, fund_return_lag - nav_return as tracking_error from j3)"""

_GAPS = """, fm as (select y, m, avg(nav_return) as monthly_nav_return, avg(fund_return_lag) as monthly_fund_return from panel group by y, m),
im as (select y, m, avg(idx_return) / 30.0 as monthly_index_adj from v_index_monthly group by y, m),
gaps as (select fm.*, im.monthly_index_adj, abs(monthly_fund_return - monthly_nav_return) as fund_nav,
  abs(monthly_nav_return - monthly_index_adj) as nav_index from fm join im on fm.y = im.y and fm.m = im.m)"""

_LIQ = """, liq as (select cast(fund_text as bigint) as code, cast(year(d) as int) as y, cast(month(d) as int) as m, avg(nav) as c
  from v_nav_daily group by all),
avgliq as (select y, m, avg(abs(c)) / 10000.0 as average_liquidity from liq where code in (select code from u) group by y, m)"""

_YEARLY = """, fy as (select code, y, sum(nav_return) as yearly_nav_return, sum(fund_return_lag) as yearly_fund_return from panel group by code, y),
iy as (select code as index_code, y, sum(idx_return) as idx_return from v_index_monthly group by code, y),
yearly as (select fy.*, p.index_code, iy.idx_return from fy join (select distinct code, code as index_code from v_index_monthly) p
  on fy.code = p.code join iy on p.index_code = iy.index_code and fy.y = iy.y)"""

_GAP1 = "abs(1 - case when isnan(regr_slope({y}, {x})) then null else regr_slope({y}, {x}) end)"

_TE = _YEARLY + f""", te as (select code,
  {_GAP1.format(y='yearly_fund_return', x='idx_return')} as coef_gap_fund_index,
  {_GAP1.format(y='yearly_fund_return', x='yearly_nav_return')} as coef_gap_fund_nav,
  {_GAP1.format(y='yearly_nav_return', x='idx_return')} as coef_gap_nav_index,
  stddev_samp(yearly_fund_return - idx_return) as fund_index_std,
  stddev_samp(yearly_fund_return - yearly_nav_return) as fund_nav_std,
  stddev_samp(yearly_nav_return - idx_return) as nav_index_std from yearly group by code)"""

_FLAGS = _LIQ + """, cash as (select cast(fund_text as bigint) as code, cast(year(d) as int) as y, cast(month(d) as int) as m,
  sum(fund_return_pct) as monthly_cashdiffer from v_nav_daily group by all),
o as (select o_custkey % 10 as code, cast(year(o_orderdate) as int) as y, cast(month(o_orderdate) as int) as m,
  o_orderstatus, o_orderpriority, o_totalprice from orders),
dv as (select distinct code, y, m from o where o_orderpriority = '1-URGENT'),
sh as (select code, y, m, sum(case when o_orderstatus = 'F' then o_totalprice end) as purchase,
  sum(case when o_orderstatus = 'O' then o_totalprice end) as redemption, sum(o_totalprice) as opening from o group by all),
d1 as (select code, y, m, case when opening <> 0 and abs(coalesce(purchase, 0) - coalesce(redemption, 0)) / opening >= 0.1
  then 1 else 0 end as dum1 from sh),
base as (select l.code, l.y, l.m, abs(l.c) as liquidity_value, c.monthly_cashdiffer,
  case when dv.code is not null then 1 else 0 end as dum2, d1.dum1
  from liq l join cash c on l.code = c.code and l.y = c.y and l.m = c.m
  left join dv on l.code = dv.code and l.y = dv.y and l.m = dv.m
  left join d1 on l.code = d1.code and l.y = d1.y and l.m = d1.m),
flags as (select *, last_value(dum1 ignore nulls) over (partition by code order by y, m
  rows between unbounded preceding and current row) as dum1_filled from base)"""

_MS = """, ms as (select code, y, m, sum(nav_return) as monthly_nav_return, sum(fund_return_lag) as monthly_fund_return
  from panel group by code, y, m),
oi as (select code, y, m, min(idx_return) as idx_return from v_index_monthly group by code, y, m),
mj as (select ms.*, oi.idx_return from ms join oi on ms.code = oi.code and ms.y = oi.y and ms.m = oi.m)"""

ORACLE = {
    "d13_fund_nav_panel": W(f"with {_PANEL} select * from panel", "v_nav_daily"),
    "d13_fund_nav_panel_no_reset": W(f"""with {_PANEL.replace('partition by code order by d', 'order by code, d')}
select code, d, nav_lag, fund_return_lag from panel""", "v_nav_daily"),
    "d14_monthly_gaps": W(f"with {_PANEL}{_GAPS} select * from gaps", "v_nav_daily", "v_index_monthly"),
    "d15_liquidity_join": W(f"""with {_PANEL}{_GAPS}{_LIQ}
select g.y, g.m, g.fund_nav, g.nav_index, a.average_liquidity from gaps g left join avgliq a on g.y = a.y and g.m = a.m""",
                            "v_nav_daily", "v_index_monthly"),
    "d16_yearly_returns": W(f"with {_PANEL}{_YEARLY} select * from yearly", "v_nav_daily", "v_index_monthly"),
    "d17_tracking_error": W(f"with {_PANEL}{_TE} select * from te", "v_nav_daily", "v_index_monthly"),
    "d18_method_corr": W(f"with {_PANEL}{_TE} " + " union all ".join(
        f"select '{a}' as var, '{b}' as with_var, case when stddev_samp({a}) * stddev_samp({b}) <> 0 then "
        f"covar_samp({a}, {b}) / (stddev_samp({a}) * stddev_samp({b})) end as r, cast(count(*) as bigint) as n "
        f"from te where {a} is not null and {b} is not null" for a in FD.TE_COLUMNS for b in FD.TE_COLUMNS),
        "v_nav_daily", "v_index_monthly"),
    "d19_factor_flags": W(f"with {_PANEL}{_FLAGS} select code, y, m, liquidity_value, monthly_cashdiffer, dum2, dum1, dum1_filled from flags",
                          "v_nav_daily"),
    "d20_factor_panel": W(f"""with {_PANEL}{_FLAGS}{_MS}
select mj.code, mj.y, mj.m, abs(monthly_fund_return - idx_return) as fund_index, abs(monthly_fund_return - monthly_nav_return) as fund_nav,
  abs(monthly_nav_return - idx_return) as nav_index, f.liquidity_value, f.monthly_cashdiffer, f.dum1_filled as dum1, f.dum2
from mj join flags f on mj.code = f.code and mj.y = f.y and mj.m = f.m""", "v_nav_daily", "v_index_monthly"),
    "d21_cross_section_gaps": W(f"""with {_PANEL}{_LIQ}{_MS}
select y, m, {_GAP1.format(y='monthly_fund_return', x='idx_return')} as coef_gap_fund_index,
  {_GAP1.format(y='monthly_fund_return', x='monthly_nav_return')} as coef_gap_fund_nav,
  {_GAP1.format(y='monthly_nav_return', x='idx_return')} as coef_gap_nav_index,
  (select average_liquidity from avgliq a where a.y = mj.y and a.m = mj.m) as average_liquidity
from mj where exists (select 1 from avgliq a where a.y = mj.y and a.m = mj.m) group by y, m""", "v_nav_daily", "v_index_monthly"),
    "d21_fund_month_differences": W(f"""with {_PANEL}{_MS}
select code, y, m, abs(monthly_fund_return - monthly_nav_return) as fund_nav_difference,
  abs(monthly_fund_return - idx_return) as fund_index_difference, abs(monthly_nav_return - idx_return) as nav_index_difference from mj""",
                                    "v_nav_daily", "v_index_monthly"),
}
