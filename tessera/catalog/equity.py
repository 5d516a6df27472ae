"""Catalog: equity-signal jobs D7-D12 (advertising-growth study)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.catalog.common import T, V, W, ols3_sql
from tessera.operators import ordered as O
from tessera.plans import equity as E

YEARS = (1996, 2001)
LO, HI = 199601, 200112
FLOOR = 100000


def d7_status_timeline(spark, sf):
    o = T(spark, sf, "orders")
    panel = o.select((F.col("o_custkey") % 100).alias("entity"), F.year("o_orderdate").cast("int").alias("y"),
                     F.month("o_orderdate").cast("int").alias("m")).distinct()
    return E.status_timeline(panel, V(spark, sf, "v_notices"))


def _panel(spark, sf):
    return E.return_panel(V(spark, sf, "v_returns"), year_range=YEARS)


def d8_return_panel(spark, sf):
    return _panel(spark, sf)


def d9_ratio_growth(spark, sf):
    return E.ratio_growth(V(spark, sf, "v_statements"), floor=FLOOR)


def _port(spark, sf):
    g = E.ratio_growth(V(spark, sf, "v_statements"), floor=FLOOR)
    groups = O.quantile_groups(g, "y", "g", 10, "ntile", out="grp", tiebreak=["entity"]).select("entity", "y", "grp")
    j = _panel(spark, sf).join(groups, ["entity", "y"])
    return E.single_sort(j, "grp", LO, HI)


def d10_single_sort(spark, sf):
    return _port(spark, sf)


def d11_high_low(spark, sf):
    return E.high_low(_port(spark, sf))


def _with_hl(spark, sf):
    p = _port(spark, sf)
    return p.unionByName(E.high_low(p).withColumn("n", F.lit(None).cast("bigint")))


def d12_raw_returns(spark, sf):
    return E.raw_returns(_with_hl(spark, sf), "ew")


def d12_capm_alpha_ew(spark, sf):
    return E.capm_alpha(_with_hl(spark, sf), V(spark, sf, "v_factors"), "ew")


def d12_capm_alpha_vw(spark, sf):
    return E.capm_alpha(_with_hl(spark, sf), V(spark, sf, "v_factors"), "vw")


def d12_ff3_alpha(spark, sf):
    return E.ff3_alpha(_with_hl(spark, sf), V(spark, sf, "v_factors"), "vw")


def d12_ff3_estimates(spark, sf):
    """As ``d12_ff3_alpha``, without the p-value that SQL has no function for."""
    return d12_ff3_alpha(spark, sf).drop("p_value")


WINDOW = (199701, 200006)


def d12_raw_returns_window(spark, sf):
    return E.factor_alphas(_with_hl(spark, sf), V(spark, sf, "v_factors"), "vw", "raw", WINDOW)


def d12_capm_alpha_window(spark, sf):
    return E.factor_alphas(_with_hl(spark, sf), V(spark, sf, "v_factors"), "vw", "capm", WINDOW)


QUERIES = {k: v for k, v in globals().items() if k[:1] == "d" and k[1:2].isdigit() and callable(v)}

_OUT = ", ".join(f"'{c}'" for c in E.STATUS_CODES["out"])
_IN = ", ".join(f"'{c}'" for c in E.STATUS_CODES["in"])
_ORD = "order by y, m, notice_date nulls first, notice_id nulls first"

_D8 = f"""panel as (select entity, y, m, ret, mv, lag(mv) over (partition by entity order by y, m) as mvlag,
  make_date(y, m, 28) as date, cast(case when m >= 5 then y else y - 1 end as int) as yearr
  from v_returns where ret is not null and mv is not null and y between {YEARS[0]} and {YEARS[1]})"""
_D9 = f"""d9a as (select entity, y, m, spend, cap, case when cap <> 0 then spend / cap end as ratio
  from v_statements where m <> 1 and spend > {FLOOR} and m = 12),
d9b as (select entity, y, ratio, lag(ratio, 1) over (partition by entity order by y) as l1,
  lag(ratio, 2) over (partition by entity order by y) as l2 from d9a),
d9 as (select entity, y, ratio, l1, l2, case when l1 <> 0 then (l1 - l2) / l1 end as g from d9b
  where l1 is not null and l2 is not null)"""
_PORT = _D8 + ",\n" + _D9 + f""",
grp as (select entity, y, cast(ntile(10) over (partition by y order by g, entity) as int) as grp from d9 where g is not null),
j as (select p.*, grp.grp from panel p join grp on p.entity = grp.entity and p.y = grp.y),
port as (select cast(grp as varchar) as grp, y, m, avg(ret) as ew,
  case when sum(case when ret is not null and mvlag is not null then mvlag end) <> 0 then
    sum(case when ret is not null and mvlag is not null then ret * mvlag end) /
    sum(case when ret is not null and mvlag is not null then mvlag end) end as vw,
  cast(count(*) as bigint) as n from j where (y * 100 + m) between {LO} and {HI} and grp is not null group by all),
hl as (select 'H-L' as grp, y, m, max(case when grp = '10' then ew end) - max(case when grp = '1' then ew end) as ew,
  max(case when grp = '10' then vw end) - max(case when grp = '1' then vw end) as vw
  from port where grp in ('10', '1') group by y, m
  having count(*) filter (where grp = '10') > 0 and count(*) filter (where grp = '1') > 0),
allp as (select grp, y, m, ew, vw, n from port union all select grp, y, m, ew, vw, null from hl)"""

_CAPM = """, cj as (select a.grp, case when a.grp = 'H-L' then a.{w} else a.{w} - f.rf end as yv, f.mkt as xv
  from allp a join v_factors f on a.y = f.y and a.m = f.m),
cg as (select grp, regr_intercept(yv, xv) as alpha, regr_slope(yv, xv) as beta, regr_r2(yv, xv) as r2,
  cast(regr_count(yv, xv) as bigint) as n, regr_sxx(yv, xv) as sxx, regr_syy(yv, xv) as syy, regr_sxy(yv, xv) as sxy,
  avg(xv) filter (where yv is not null) as mx from cj where yv is not null and xv is not null group by grp)
select grp, alpha, beta, case when isnan(r2) then null else r2 end as r2, n,
  case when n > 2 then alpha / sqrt((syy - sxy * sxy / sxx) / (n - 2) * (1.0 / n + mx * mx / sxx)) end as t_alpha from cg"""

ORACLE = {
    "d7_status_timeline": W(f"""
with n as (select notice_id, entity, notice_date, cast(year(notice_date) as int) as y, cast(month(notice_date) as int) as m,
  case when chgtype in ({_OUT}) then 'out' when chgtype in ({_IN}) then 'in' end as status from v_notices),
p as (select distinct o_custkey % 100 as entity, cast(year(o_orderdate) as int) as y, cast(month(o_orderdate) as int) as m from orders),
j as (select p.entity, p.y, p.m, n.notice_id, n.notice_date, n.status from p left join n on p.entity = n.entity and p.y = n.y and p.m = n.m),
f as (select *, case when row_number() over (partition by entity {_ORD}) = 1 then 'in' else status end as v from j),
g as (select *, last_value(v ignore nulls) over (partition by entity {_ORD} rows between unbounded preceding and current row)
  as status_filled from f),
h as (select *, coalesce(lag(status_filled) over (partition by entity {_ORD}), 'in') as decision,
  row_number() over (partition by entity, y, m order by notice_date nulls first, notice_id nulls first) as rn from g)
select entity, y, m, status_filled, decision from h where rn = 1""", "v_notices"),
    "d8_return_panel": W(f"with {_D8} select * from panel", "v_returns"),
    "d9_ratio_growth": W(f"with {_D9} select * from d9", "v_statements"),
    "d10_single_sort": W(f"with {_PORT} select * from port", "v_returns", "v_statements"),
    "d11_high_low": W(f"with {_PORT} select grp, y, m, ew, vw from hl", "v_returns", "v_statements"),
    "d12_raw_returns": W(f"""with {_PORT} select grp, avg(ew) as mean, stddev_samp(ew) as sd, cast(count(ew) as bigint) as n,
  avg(ew) / (stddev_samp(ew) / sqrt(count(ew))) as t from allp group by grp""", "v_returns", "v_statements"),
    "d12_ff3_estimates": W(f"with {_PORT},\nfj as (select a.grp, f.mkt, f.smb, f.hml, case when a.grp = 'H-L' then a.vw else a.vw - f.rf end as ex_ret"
                           " from allp a join v_factors f on a.y = f.y and a.m = f.m),\n"
                           + ols3_sql("fj", "grp", "ex_ret", ("mkt", "smb", "hml")), "v_returns", "v_statements", "v_factors"),
    "d12_raw_returns_window": W(f"""with {_PORT} select grp, avg(vw) as mean, stddev_samp(vw) as sd, cast(count(vw) as bigint) as n,
  avg(vw) / (stddev_samp(vw) / sqrt(count(vw))) as t from allp where y * 100 + m between {WINDOW[0]} and {WINDOW[1]} group by grp""",
                                "v_returns", "v_statements"),
    "d12_capm_alpha_window": W(f"with {_PORT}" + _CAPM.format(w="vw").replace("from allp a", f"from (select * from allp where y * 100 + m between {WINDOW[0]} and {WINDOW[1]}) a"),
                               "v_returns", "v_statements", "v_factors"),
    "d12_capm_alpha_ew": W(f"with {_PORT}" + _CAPM.format(w="ew"), "v_returns", "v_statements", "v_factors"),
    "d12_capm_alpha_vw": W(f"with {_PORT}" + _CAPM.format(w="vw"), "v_returns", "v_statements", "v_factors"),
}
