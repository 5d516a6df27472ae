"""Catalog: aggregation and description A1-A20 (A6-A8 are in the fuel catalog)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.catalog.common import T, V, W
from tessera.functions.scalar import band
from tessera.operators import aggregate as A
from tessera.plans.fixtures import BASE_TABLES


def a1_sum_by(spark, sf):
    return A.sum_by(V(spark, sf, "v_orders_gaps"), ["priority", "o_orderstatus"], ["price"], nulls="pandas")


def a2_sum_by_sql(spark, sf):
    return A.sum_by(V(spark, sf, "v_orders_gaps"), ["priority"], ["price"], nulls="sql")


def a3_mean_by(spark, sf):
    r = V(spark, sf, "v_returns")
    m = A.mean_by(r, ["y", "m"], ["ret"])
    s = A.mean_by(r, ["y", "m"], ["mv"], scale=10000, suffix="_scaled")
    return m.join(s, ["y", "m"])


def a4_std_by(spark, sf):
    return A.std_by(V(spark, sf, "v_returns"), ["entity"], "ret")


def a5_count_by(spark, sf):
    return A.count_by(V(spark, sf, "v_orders_gaps"), ["o_orderstatus"], ["price", "priority"])


def a9_band_share(spark, sf):
    o = T(spark, sf, "orders").withColumn("band", band("o_totalprice", [100000, 200000, 300000]))
    return A.band_share(o, ["o_orderstatus"], "o_orderpriority", "band", bands=[1, 2, 3, 4])


def a10_proportions(spark, sf):
    o = T(spark, sf, "orders")
    t = (o.groupBy("o_custkey")
         .agg(F.sum(F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice")).otherwise(0.0)).alias("f_total"),
              F.sum(F.when(F.col("o_orderstatus") == "O", F.col("o_totalprice")).otherwise(0.0)).alias("o_total"))
         .withColumn("total", F.col("f_total") + F.col("o_total")))
    return A.proportions(t, ["f_total", "o_total"], "total")


def a11_value_counts(spark, sf):
    return A.value_counts(T(spark, sf, "labels"), "quality")


def a12_null_profile(spark, sf):
    return A.null_profile(V(spark, sf, "v_orders_gaps"))


def a13_null_patterns(spark, sf):
    return A.null_patterns(V(spark, sf, "v_orders_gaps"), ["price", "priority"])


def a14_summary(spark, sf):
    return A.summary(T(spark, sf, "part"), ["p_size", "p_retailprice"]).unionByName(
        A.summary(T(spark, sf, "orders"), ["o_totalprice"]))


def a15_box_stats(spark, sf):
    return A.box_stats(T(spark, sf, "orders"), ["o_orderstatus"], "o_totalprice")


def a16_histogram(spark, sf):
    return A.histogram(T(spark, sf, "lineitem"), "l_discount", 6, 0.0, 0.1)


def a17_histogram2d(spark, sf):
    o = T(spark, sf, "orders").withColumn("month", F.month("o_orderdate"))
    return A.histogram2d(o, "month", "o_totalprice", 12)


def a18_distinct_values(spark, sf):
    return A.distinct_values(T(spark, sf, "orders"), "o_orderpriority")


def a19_shape(spark, sf):
    out = None
    for t in BASE_TABLES:
        s = A.shape(T(spark, sf, t)).select(F.lit(t).alias("table_name"), "n_rows", "n_cols")
        out = s if out is None else out.unionByName(s)
    return out


def a20_score_summary(spark, sf):
    return A.score_summary(T(spark, sf, "events"), "value", ["event_type"])


QUERIES = {k: v for k, v in globals().items() if k[:1] == "a" and k[1:2].isdigit() and callable(v)}

_SUMMARY = """select '{c}' as column_name, min({c})::double as min, quantile_cont({c}, 0.25)::double as q1,
  quantile_cont({c}, 0.5)::double as median, avg({c})::double as mean, quantile_cont({c}, 0.75)::double as q3,
  max({c})::double as max, cast(count(*) filter (where {c} is null) as bigint) as n_missing from {t}"""

ORACLE = {
    "a1_sum_by": W("""select priority, o_orderstatus, coalesce(sum(price), 0) as price from v_orders_gaps
  where priority is not null and o_orderstatus is not null group by all""", "v_orders_gaps"),
    "a2_sum_by_sql": W("select priority, sum(price) as price from v_orders_gaps group by priority", "v_orders_gaps"),
    "a3_mean_by": W("select y, m, avg(ret) as ret, avg(mv) / 10000.0 as mv_scaled from v_returns group by y, m", "v_returns"),
    "a4_std_by": W("select entity, stddev_samp(ret) as std_ret, cast(count(ret) as bigint) as n from v_returns group by entity",
                   "v_returns"),
    "a5_count_by": W("""select o_orderstatus, cast(count(price) as bigint) as price, cast(count(priority) as bigint) as priority
  from v_orders_gaps where o_orderstatus is not null group by o_orderstatus""", "v_orders_gaps"),
    "a9_band_share": """
with b as (select o_orderstatus, o_orderpriority, case when o_totalprice <= 100000 then 1 when o_totalprice <= 200000 then 2
  when o_totalprice <= 300000 then 3 when o_totalprice is not null then 4 end as band from orders),
tot as (select o_orderstatus, o_orderpriority, count(*) as tot from b group by all),
cnt as (select o_orderstatus, o_orderpriority, band, count(*) as n from b group by all),
grid as (select t.*, k.band from tot t, (values (1), (2), (3), (4)) k(band))
select g.o_orderstatus, g.o_orderpriority, g.band, coalesce(c.n, 0) * 100.0 / g.tot as percent
from grid g left join cnt c on g.o_orderstatus = c.o_orderstatus and g.o_orderpriority = c.o_orderpriority and g.band = c.band""",
    "a10_proportions": """
with t as (select o_custkey, sum(case when o_orderstatus = 'F' then o_totalprice else 0 end) as f_total,
  sum(case when o_orderstatus = 'O' then o_totalprice else 0 end) as o_total from orders group by o_custkey)
select o_custkey, f_total, o_total, f_total + o_total as total,
  case when f_total + o_total <> 0 then f_total / (f_total + o_total) end as f_total_share,
  case when f_total + o_total <> 0 then o_total / (f_total + o_total) end as o_total_share from t""",
    "a11_value_counts": "select quality, cast(count(*) as bigint) as count from labels where quality is not null group by quality",
    "a12_null_profile": W("""
with n as (
select 'o_orderkey' as column_name, count(*) filter (where o_orderkey is null) as n_missing from v_orders_gaps
union all select 'o_custkey', count(*) filter (where o_custkey is null) from v_orders_gaps
union all select 'o_orderstatus', count(*) filter (where o_orderstatus is null) from v_orders_gaps
union all select 'o_orderdate', count(*) filter (where o_orderdate is null) from v_orders_gaps
union all select 'price', count(*) filter (where price is null or isnan(price)) from v_orders_gaps
union all select 'priority', count(*) filter (where priority is null) from v_orders_gaps)
select column_name, cast(n_missing as bigint) as n_missing, n_missing > 0 as any_missing from n""", "v_orders_gaps"),
    "a13_null_patterns": W("""select cast(price is null as int) as price_missing, cast(priority is null as int) as priority_missing,
  cast(count(*) as bigint) as n from v_orders_gaps group by all""", "v_orders_gaps"),
    "a14_summary": " union all ".join([_SUMMARY.format(c="p_size", t="part"), _SUMMARY.format(c="p_retailprice", t="part"),
                                       _SUMMARY.format(c="o_totalprice", t="orders")]),
    "a15_box_stats": """
with q as (select o_orderstatus, quantile_cont(o_totalprice, 0.25) as q1, quantile_cont(o_totalprice, 0.5) as median,
  quantile_cont(o_totalprice, 0.75) as q3 from orders where o_totalprice is not null group by o_orderstatus),
j as (select o.o_orderstatus, o.o_totalprice as v, q.q1, q.median, q.q3, q.q1 - 1.5 * (q.q3 - q.q1) as lo,
  q.q3 + 1.5 * (q.q3 - q.q1) as hi from orders o join q on o.o_orderstatus = q.o_orderstatus where o.o_totalprice is not null)
select o_orderstatus, q1, median, q3, min(case when v >= lo and v <= hi then v end) as whisker_lo,
  max(case when v >= lo and v <= hi then v end) as whisker_hi,
  cast(count(*) filter (where not (v >= lo and v <= hi)) as bigint) as n_outliers, cast(count(*) as bigint) as n
from j group by o_orderstatus, q1, median, q3""",
    "a16_histogram": """
with b as (select case when l_discount = 0.1 then 5 else least(cast(floor(6 * (l_discount - 0.0) / (0.1 - 0.0)) as int), 5) end as b
  from lineitem where l_discount >= 0.0 and l_discount <= 0.1),
g as (select range::int as b from range(6))
select g.b + 1 as bin, 0.0 + g.b * (0.1 / 6) as bin_lo, 0.0 + (g.b + 1) * (0.1 / 6) as bin_hi,
  cast(count(b.b) as bigint) as count from g left join b on g.b = b.b group by g.b""",
    "a17_histogram2d": """
with s as (select cast(month(o_orderdate) as double) as x, o_totalprice as y from orders),
l as (select min(x) as x0, max(x) as x1, min(y) as y0, max(y) as y1 from s),
b as (select case when x = x1 then 11 else least(cast(floor(12 * (x - x0) / (x1 - x0)) as int), 11) end as xbin,
             case when y = y1 then 11 else least(cast(floor(12 * (y - y0) / (y1 - y0)) as int), 11) end as ybin from s, l),
g as (select (range // 12)::int as xbin, (range % 12)::int as ybin from range(144))
select g.xbin + 1 as xbin, g.ybin + 1 as ybin, cast(count(b.xbin) as bigint) as count
from g left join b on g.xbin = b.xbin and g.ybin = b.ybin group by g.xbin, g.ybin""",
    "a18_distinct_values": "select distinct o_orderpriority from orders",
    "a19_shape": " union all ".join(
        f"select '{t}' as table_name, cast(count(*) as bigint) as n_rows, "
        f"cast((select count(*) from (describe {t})) as bigint) as n_cols from {t}" for t in BASE_TABLES),
    "a20_score_summary": """select event_type, avg(value) as mean, stddev_pop(value) as std_pop, cast(count(value) as bigint) as n
  from events group by event_type""",
}
