"""Catalog: price elasticity D22-D23 and product boxes D24-D28."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.catalog.common import T, V, W
from tessera.plans import bundle as B
from tessera.plans import retail as R

def _monthly(spark, sf):
    return V(spark, sf, "v_brand_month")


def d22_elasticity(spark, sf):
    return R.elasticity_by_brand(_monthly(spark, sf)).drop("r2", "n")


def d22_elasticity_summary(spark, sf):
    fits = R.elasticity_by_brand(_monthly(spark, sf))
    return fits.groupBy("brand", "model").agg(F.max("r2").alias("r2"), F.max("n").alias("n"), F.count("estimate").cast("bigint").alias("n_terms"))


def d22_loglog_simple(spark, sf):
    c = R.elasticity_by_brand(_monthly(spark, sf))
    return c.where(F.col("model") == "m2").drop("model", "p_value", "r2", "n")


def d23_price_quantity_series(spark, sf):
    return R.brand_series(_monthly(spark, sf))


def d23_price_quantity_tests(spark, sf):
    return R.price_quantity_tests(R.brand_series(_monthly(spark, sf)), ["brand"]).drop("p")


def _profit(spark, sf):
    return B.profit_matrix(V(spark, sf, "v_cost"))


def d24_profit_matrix(spark, sf):
    return _profit(spark, sf)


def d25_evaluate_plan(spark, sf):
    return B.evaluate_plan(V(spark, sf, "v_plan_x"), V(spark, sf, "v_plan_y"), _profit(spark, sf))


def d26_check_plan(spark, sf):
    return B.check_plan(V(spark, sf, "v_plan_x"), V(spark, sf, "v_plan_y"), V(spark, sf, "v_segments"))


def d27_score_bundles(spark, sf):
    cand = (V(spark, sf, "v_products").join(T(spark, sf, "part"), F.col("product") == F.col("p_partkey"))
            .select(F.col("p_brand").alias("bundle"), "product"))
    return B.score_bundles(cand, _profit(spark, sf), k=3)


def d28_plan_report(spark, sf):
    return B.plan_report(V(spark, sf, "v_plan_x"), V(spark, sf, "v_plan_y"),
                         V(spark, sf, "v_products").select("product", "product_name"))


QUERIES = {k: v for k, v in globals().items() if k[:1] == "d" and k[1:2].isdigit() and callable(v)}

_SERIES = """s as (select brand, y, m, price, units, case when price > 0 then ln(price) end as ln_price,
  case when units > 0 then ln(units) end as ln_units from v_brand_month)"""


def _test(x, y, scale):
    return f"""select brand, '{scale}' as scale, r, cast(n as bigint) as n, cast(n - 2 as bigint) as df, r * sqrt((n - 2) / (1 - r * r)) as t,
  case when n > 3 then tanh(atanh(r) - 1.959963984540054 / sqrt(n - 3)) end as ci_lo,
  case when n > 3 then tanh(atanh(r) + 1.959963984540054 / sqrt(n - 3)) end as ci_hi
  from (select brand, case when stddev_samp({x}) * stddev_samp({y}) <> 0 then covar_samp({x}, {y}) / (stddev_samp({x}) * stddev_samp({y})) end as r,
  count(*) as n from s where {x} is not null and {y} is not null group by brand) c"""


ORACLE = {
    "d22_loglog_simple": W(f"""with {_SERIES},
g as (select brand, regr_intercept(ln_units, ln_price) as b0, regr_slope(ln_units, ln_price) as b1, regr_count(ln_units, ln_price) as n,
  regr_sxx(ln_units, ln_price) as sxx, regr_syy(ln_units, ln_price) as syy, regr_sxy(ln_units, ln_price) as sxy,
  avg(ln_price) filter (where ln_units is not null) as mx from s group by brand),
e as (select *, (syy - sxy * sxy / sxx) / (n - 2) as s2 from g)
select brand, '(Intercept)' as term, b0 as estimate, sqrt(s2 * (1.0 / n + mx * mx / sxx)) as std_error,
  b0 / sqrt(s2 * (1.0 / n + mx * mx / sxx)) as t_value from e
union all select brand, 'ln_p_own', b1, sqrt(s2 / sxx), b1 / sqrt(s2 / sxx) from e""", "v_brand_month"),
    "d23_price_quantity_series": W(f"with {_SERIES} select * from s", "v_brand_month"),
    "d23_price_quantity_tests": W(f"with {_SERIES} {_test('price', 'units', 'level')} union all {_test('ln_price', 'ln_units', 'log')}",
                                  "v_brand_month"),
    "d24_profit_matrix": W("select product, segment, n, cost, n * (8 - cost) as profit from v_cost", "v_cost"),
    "d25_evaluate_plan": W("""select cast(sum(c.n * 8) as double) as revenue, cast(sum(c.n * c.cost) as double) as cost,
  cast(sum(c.n * (8 - c.cost)) as double) as profit, cast(count(*) as bigint) as n_pairs
  from v_plan_x x join v_plan_y y on x.box = y.box join v_cost c on c.product = x.product and c.segment = y.segment""",
                           "v_plan_x", "v_plan_y", "v_cost"),
    "d26_check_plan": W("""select 'box_size' as rule, cast(box as varchar) as key, cast(count(*) as bigint) as value,
  count(*) between 4 and 7 as ok from v_plan_x group by box
union all select 'segment_boxes', s.segment, cast(coalesce(b.nb, 0) as bigint), coalesce(b.nb, 0) = 1
  from v_segments s left join (select segment, count(*) as nb from v_plan_y group by segment) b on s.segment = b.segment
union all select 'product_cap', cast(x.product as varchar), cast(sum(s.n) as bigint), sum(s.n) <= 80000
  from v_plan_x x join v_plan_y y on x.box = y.box join v_segments s on s.segment = y.segment group by x.product""",
                        "v_plan_x", "v_plan_y", "v_segments"),
    "d27_score_bundles": W("""with c as (select p.p_brand as bundle, v.product from v_products v join part p on v.product = p.p_partkey),
s as (select c.bundle, k.segment, cast(sum(k.n * (8 - k.cost)) as bigint) as profit, cast(count(*) as bigint) as n_products
  from c join v_cost k on c.product = k.product group by c.bundle, k.segment),
r as (select *, cast(row_number() over (partition by segment order by profit desc, bundle) as int) as rank from s)
select * from r where rank <= 3""", "v_products", "v_cost"),
    "d28_plan_report": W("""with i as (select x.box, string_agg(p.product_name, ', ' order by p.product_name) as products,
  cast(count(*) as bigint) as n_products from v_plan_x x left join v_products p on x.product = p.product group by x.box),
g as (select box, string_agg(segment, ', ' order by segment) as segments from v_plan_y group by box)
select coalesce(i.box, g.box) as box, i.products, i.n_products, g.segments from i full outer join g on i.box = g.box""",
                         "v_plan_x", "v_plan_y", "v_products"),
}
