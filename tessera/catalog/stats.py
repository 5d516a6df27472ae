"""Catalog: statistics T1-T7."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.catalog.common import V, W, T, ols3_sql
from tessera.operators import stats as S

LI_VARS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "net_price", "charge"]
_NET = "l_extendedprice * (1 - l_discount)"
_CHARGE = "l_extendedprice * (1 - l_discount) * (1 + l_tax)"


def t1_corr_by(spark, sf):
    return S.corr_by(V(spark, sf, "v_returns"), ["entity"], "ret", "mv")


def t2_corr_matrix(spark, sf):
    li = T(spark, sf, "lineitem").withColumns({"net_price": F.expr(_NET), "charge": F.expr(_CHARGE)})
    return S.corr_matrix(li, LI_VARS)


def _brand_logs(spark, sf):
    return V(spark, sf, "v_brand_month").select("brand", F.ln("price").alias("ln_price"), F.ln("units").alias("ln_units"))


def t3_corr_test(spark, sf):
    return S.corr_test(_brand_logs(spark, sf), "ln_price", "ln_units", ["brand"]).drop("p")


def t3_corr_test_p(spark, sf):
    return S.corr_test(_brand_logs(spark, sf), "ln_price", "ln_units", ["brand"])


def _ret_mkt(spark, sf):
    return V(spark, sf, "v_returns").join(V(spark, sf, "v_factors"), ["y", "m"])


def t4_ols_by(spark, sf):
    return S.ols_by(_ret_mkt(spark, sf), ["entity"], "ret", "mkt")


def t4_ols_by_month(spark, sf):
    return S.ols_by(_ret_mkt(spark, sf), ["y", "m"], "ret", "mkt")


def t5_beta_gap(spark, sf):
    return S.ols_by(_ret_mkt(spark, sf), ["entity"], "ret", "mkt").select("entity", S.beta_gap("slope").alias("beta_gap"))


def t6_ols_simple(spark, sf):
    res = S.ols(V(spark, sf, "v_brand_month"), "units", ["price"], residual_quantiles=False)
    return res.coefficients.drop("p_value")


def t6_ols_multi(spark, sf):
    b = V(spark, sf, "v_brand_month").withColumns({
        "ln_price": F.ln("price"), "ln_units": F.ln("units"),
        "major": (F.col("sale") == 1).cast("int"), "minor": (F.col("sale") == 2).cast("int")})
    res = S.ols(b, "ln_units", ["ln_price", "major", "minor", "ln_price"])
    return res.coefficients


def t7_ols_multi_by(spark, sf):
    d = _ret_mkt(spark, sf).withColumn("ex_ret", F.col("ret") - F.col("rf"))
    return S.ols_multi_by(d, ["entity"], "ex_ret", ["mkt", "smb", "hml"])


def t7_ols_multi_by_estimates(spark, sf):
    """As ``t7_ols_multi_by``, without the p-value that SQL has no function for."""
    return t7_ols_multi_by(spark, sf).drop("p_value")


QUERIES = {k: v for k, v in globals().items() if k[:1] == "t" and k[1:2].isdigit() and callable(v)}


def _r(x, y):
    return (f"case when stddev_samp({x}) * stddev_samp({y}) <> 0 then covar_samp({x}, {y}) / "
            f"(stddev_samp({x}) * stddev_samp({y})) end")


def _pairs_sql():
    parts = []
    for v in LI_VARS:
        for w in LI_VARS:
            parts.append(f"select '{v}' as var, '{w}' as with_var, {_r(v, w)} as r, cast(count(*) as bigint) as n, "
                         f"avg({v}) as mean_var, stddev_samp({v}) as std_var, cast(count({v}) as bigint) as n_var from lineitem "
                         f"where {v} is not null and {w} is not null")
    return (f"with li as (select *, {_NET} as net_price, {_CHARGE} as charge from lineitem) "
            + " union all ".join(parts).replace(" from lineitem ", " from li "))


_OLS = """with r as (select * from v_returns join v_factors using (y, m)),
g as (select {keys}, regr_intercept(ret, mkt) as intercept, regr_slope(ret, mkt) as slope, regr_r2(ret, mkt) as r2,
  cast(regr_count(ret, mkt) as bigint) as n, regr_sxx(ret, mkt) as sxx, regr_syy(ret, mkt) as syy, regr_sxy(ret, mkt) as sxy
  from r group by {keys})
select {keys}, case when isnan(intercept) then null else intercept end as intercept,
  case when isnan(slope) then null else slope end as slope, case when isnan(r2) then null else r2 end as r2, n,
  case when n > 2 then sqrt(greatest(syy - case when sxx <> 0 then sxy * sxy / sxx end, 0) / (n - 2)) end as rmse from g"""

ORACLE = {
    "t1_corr_by": W(f"select entity, {_r('ret', 'mv')} as r, cast(count(ret) as bigint) as n from v_returns group by entity", "v_returns"),
    "t2_corr_matrix": _pairs_sql(),
    "t3_corr_test": W(f"""with b as (select brand, ln(price) as x, ln(units) as y from v_brand_month),
c as (select brand, {_r('x', 'y')} as r, count(*) as n from b group by brand)
select brand, r, cast(n as bigint) as n, cast(n - 2 as bigint) as df, r * sqrt((n - 2) / (1 - r * r)) as t,
  case when n > 3 then tanh(atanh(r) - 1.959963984540054 / sqrt(n - 3)) end as ci_lo,
  case when n > 3 then tanh(atanh(r) + 1.959963984540054 / sqrt(n - 3)) end as ci_hi from c""", "v_brand_month"),
    "t4_ols_by": W(_OLS.format(keys="entity"), "v_returns", "v_factors"),
    "t4_ols_by_month": W(_OLS.format(keys="y, m"), "v_returns", "v_factors"),
    "t5_beta_gap": W("""with r as (select * from v_returns join v_factors using (y, m))
select entity, abs(1 - regr_slope(ret, mkt)) as beta_gap from r group by entity""", "v_returns", "v_factors"),
    "t7_ols_multi_by_estimates": W("with r as (select *, ret - rf as ex_ret from v_returns join v_factors using (y, m)),\n"
                                   + ols3_sql("r", "entity", "ex_ret", ("mkt", "smb", "hml")), "v_returns", "v_factors"),
    "t6_ols_simple": W("""with g as (select regr_intercept(units, price) as b0, regr_slope(units, price) as b1, regr_count(units, price) as n,
  regr_sxx(units, price) as sxx, regr_syy(units, price) as syy, regr_sxy(units, price) as sxy, avg(price) as mx from v_brand_month),
s as (select *, (syy - sxy * sxy / sxx) / (n - 2) as s2 from g)
select '(Intercept)' as term, b0 as estimate, sqrt(s2 * (1.0 / n + mx * mx / sxx)) as std_error,
  b0 / sqrt(s2 * (1.0 / n + mx * mx / sxx)) as t_value from s
union all select 'price', b1, sqrt(s2 / sxx), b1 / sqrt(s2 / sxx) from s""", "v_brand_month"),
}
