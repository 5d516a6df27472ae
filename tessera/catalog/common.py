"""Shared helpers of the query catalog (bindings of operators to the driver
tables; see FIXTURES.md)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.plans import fixtures


def T(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A driver table."""
    return fixtures.load(spark, sf, name)


def V(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A fixture view over the driver tables."""
    return fixtures.fixture(spark, sf, name)


def W(sql: str, *views: str) -> str:
    """Oracle SQL with the fixture views it needs as CTEs."""
    return fixtures.with_views(sql, *views)


def ols3_sql(rows: str, key: str, y: str, xs: tuple[str, str, str]) -> str:
    """The closed form of a regression on three variables per ``key`` of the
    CTE or table ``rows`` (inverse of the 3 x 3 covariance by cofactors), as
    CTEs and a final select: key, term, estimate, std_error, t_value, r2, n."""
    a, b, c = xs
    part = "\nunion all ".join(
        f"select {key}, '{term}' as term, {est} as estimate, {se} as std_error, ({est}) / ({se}) as t_value, r2, n from solved"
        for term, est, se in [("(Intercept)", "m_y - b_a * m_a - b_b * m_b - b_c * m_c",
                               "sqrt(s2 / n * (1 + m_a * m_a * i_aa + m_b * m_b * i_bb + m_c * m_c * i_cc"
                               " + 2 * (m_a * m_b * i_ab + m_a * m_c * i_ac + m_b * m_c * i_bc)))"),
                              (a, "b_a", "sqrt(s2 * i_aa / n)"), (b, "b_b", "sqrt(s2 * i_bb / n)"), (c, "b_c", "sqrt(s2 * i_cc / n)")])
    return f"""whole as (select {key}, cast({y} as double) as y_, cast({a} as double) as a_, cast({b} as double) as b_, cast({c} as double) as c_
  from {rows} where {y} is not null and {a} is not null and {b} is not null and {c} is not null),
mo as (select {key}, count(*) as n, avg(y_) as m_y, avg(a_) as m_a, avg(b_) as m_b, avg(c_) as m_c, var_pop(y_) as yy,
  var_pop(a_) as aa, var_pop(b_) as bb, var_pop(c_) as cc, covar_pop(a_, b_) as ab, covar_pop(a_, c_) as ac, covar_pop(b_, c_) as bc,
  covar_pop(a_, y_) as ay, covar_pop(b_, y_) as by_, covar_pop(c_, y_) as cy from whole group by {key}),
det as (select *, aa * (bb * cc - bc * bc) - ab * (ab * cc - bc * ac) + ac * (ab * bc - bb * ac) as d from mo),
inv as (select *, (bb * cc - bc * bc) / d as i_aa, (aa * cc - ac * ac) / d as i_bb, (aa * bb - ab * ab) / d as i_cc,
  (ac * bc - ab * cc) / d as i_ab, (ab * bc - ac * bb) / d as i_ac, (ab * ac - aa * bc) / d as i_bc from det),
fit as (select *, i_aa * ay + i_ab * by_ + i_ac * cy as b_a, i_ab * ay + i_bb * by_ + i_bc * cy as b_b,
  i_ac * ay + i_bc * by_ + i_cc * cy as b_c from inv),
solved as (select *, (yy - b_a * ay - b_b * by_ - b_c * cy) * n / (n - 4) as s2, (b_a * ay + b_b * by_ + b_c * cy) / yy as r2 from fit)
{part}"""
