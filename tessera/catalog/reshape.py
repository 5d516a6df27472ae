"""Catalog: reshape R1-R5."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.catalog.common import T
from tessera.operators import reshape as R

SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


def r1_widen(spark, sf):
    o = (T(spark, sf, "orders")
         .withColumns({"year": F.year("o_orderdate").cast("int"), "month": F.month("o_orderdate").cast("int"),
                       "one": F.lit(1)}))
    return R.widen(o, ["year", "month"], "o_orderstatus", ["F", "O", "P"], ["o_totalprice", "one"])


def r2_entities_as_columns(spark, sf):
    o, c, n, r = (T(spark, sf, t) for t in ("orders", "customer", "nation", "region"))
    per = (o.join(c, o["o_custkey"] == c["c_custkey"]).join(n, c["c_nationkey"] == n["n_nationkey"])
           .join(r, n["n_regionkey"] == r["r_regionkey"])
           .groupBy(F.year("o_orderdate").cast("int").alias("year"), "r_name")
           .agg(F.sum("o_totalprice").alias("total")))
    regions = sorted(x[0] for x in r.select("r_name").distinct().collect())  # a 5-row dimension
    return R.entities_as_columns(per, ["year"], "r_name", regions, "total")


def r3_lengthen(spark, sf):
    p = T(spark, sf, "part").select("p_partkey", F.col("p_size").cast("double").alias("p_size"), "p_retailprice")
    return R.lengthen(p, ["p_partkey"], ["p_size", "p_retailprice"], "measure", "value")


def r4_complete_entities(spark, sf):
    o = T(spark, sf, "orders").withColumn("year", F.year("o_orderdate").cast("int")).select("o_orderkey", "o_custkey", "year")
    return R.complete_entities(o, ["o_custkey"], "year")


def r5_dummies(spark, sf):
    c = T(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    return R.dummies(c, ["c_mktsegment"])


QUERIES = {k: v for k, v in globals().items() if k[:1] == "r" and k[1:2].isdigit() and callable(v)}

ORACLE = {
    "r1_widen": """select cast(year(o_orderdate) as int) as year, cast(month(o_orderdate) as int) as month,
  sum(o_totalprice) filter (where o_orderstatus = 'F') as F_o_totalprice, cast(sum(1) filter (where o_orderstatus = 'F') as bigint) as F_one,
  sum(o_totalprice) filter (where o_orderstatus = 'O') as O_o_totalprice, cast(sum(1) filter (where o_orderstatus = 'O') as bigint) as O_one,
  sum(o_totalprice) filter (where o_orderstatus = 'P') as P_o_totalprice, cast(sum(1) filter (where o_orderstatus = 'P') as bigint) as P_one
  from orders group by all""",
    "r2_entities_as_columns": """with per as (select cast(year(o_orderdate) as int) as year, r_name, sum(o_totalprice) as total
  from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
  join region on n_regionkey = r_regionkey group by all)
select year, max(total) filter (where r_name = 'AFRICA') as AFRICA, max(total) filter (where r_name = 'AMERICA') as AMERICA,
  max(total) filter (where r_name = 'ASIA') as ASIA, max(total) filter (where r_name = 'EUROPE') as EUROPE,
  max(total) filter (where r_name = 'MIDDLE EAST') as "MIDDLE EAST" from per group by year""",
    "r3_lengthen": """select p_partkey, 'p_size' as measure, cast(p_size as double) as value from part
  union all select p_partkey, 'p_retailprice', p_retailprice from part""",
    "r4_complete_entities": """with o as (select o_orderkey, o_custkey, cast(year(o_orderdate) as int) as year from orders),
full_ as (select o_custkey from o group by o_custkey having count(distinct year) = (select count(distinct year) from o))
select o_orderkey, o_custkey, year from o where o_custkey in (select o_custkey from full_)""",
    "r5_dummies": "select c_custkey, " + ", ".join(
        f"case when c_mktsegment = '{s}' then 1 else 0 end as c_mktsegment_{s}" for s in SEGMENTS) + " from customer",
}
