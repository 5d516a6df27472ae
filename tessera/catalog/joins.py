"""Catalog: joins J1-J12 (J10 is in the fuel catalog)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.catalog.common import T, V, W
from tessera.operators import joins as J


def j1_left_join(spark, sf):
    c = T(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    o = T(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return J.join(c, o, [("c_custkey", "o_custkey")], "left")


def j2_left_join_composite(spark, sf):
    r = V(spark, sf, "v_returns").select("entity", "y", "m", "ret")
    li = T(spark, sf, "lineitem").where(F.col("l_returnflag") == "R")
    n = (li.groupBy(F.col("l_suppkey").alias("entity"), F.year("l_shipdate").cast("int").alias("y"),
                    F.month("l_shipdate").cast("int").alias("m"))
         .agg(F.count(F.lit(1)).cast("bigint").alias("n_returned")))
    return J.join(r, n, ["entity", "y", "m"], "left")


def j3_inner_join(spark, sf):
    s = T(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
    n = T(spark, sf, "nation").select("n_nationkey", "n_name")
    return J.join(s, n, [("s_nationkey", "n_nationkey")])


def j4_inner_join_pairs(spark, sf):
    r = V(spark, sf, "v_returns").select("entity", "y", "m", "ret")
    f = V(spark, sf, "v_factors").select(F.col("y").alias("fy"), F.col("m").alias("fm"), "mkt")
    return J.join(r, f, [("y", "fy"), ("m", "fm")]).drop("fy", "fm")


def j5_outer_join(spark, sf):
    o = T(spark, sf, "orders")
    f = (o.where(F.col("o_orderstatus") == "F").groupBy("o_custkey")
         .agg(F.sum("o_totalprice").alias("f_total")))
    op = (o.where(F.col("o_orderstatus") == "O").groupBy("o_custkey")
          .agg(F.sum("o_totalprice").alias("o_total")))
    return J.join(f, op, ["o_custkey"], "full_outer")


def j6_join_all(spark, sf):
    li = T(spark, sf, "lineitem")
    a = li.groupBy("l_suppkey").agg(F.sum("l_quantity").alias("qty"))
    b = li.groupBy("l_suppkey").agg(F.avg("l_extendedprice").alias("avg_price"))
    c = li.groupBy("l_suppkey").agg(F.count(F.lit(1)).cast("bigint").alias("n_lines"))
    return J.join_all([a, b, c], ["l_suppkey"])


def j7_join_validated(spark, sf):
    o = T(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("custkey"))
    c = T(spark, sf, "customer").select(F.col("c_custkey").alias("custkey"), "c_nationkey")
    return J.join_validated(o, c, ["custkey"], "left", "many_to_one")


def j8_restrict_to(spark, sf):
    o = T(spark, sf, "orders").select("o_orderkey", "o_custkey")
    ids = T(spark, sf, "customer").where(F.col("c_mktsegment") == "BUILDING").select("c_custkey")
    return J.restrict_to(o, ids, [("o_custkey", "c_custkey")])


def j9_join_then_first(spark, sf):
    o = (T(spark, sf, "orders")
         .withColumns({"y": F.year("o_orderdate").cast("int"), "m": F.month("o_orderdate").cast("int")})
         .select("o_custkey", "y", "m", "o_orderdate", "o_orderkey", "o_totalprice"))
    month_mean = o.groupBy("y", "m").agg(F.avg("o_totalprice").alias("month_mean"))
    return J.join_then_first(o, month_mean, ["y", "m"], ["o_custkey", "y", "m"], ["o_orderdate", "o_orderkey"])


def j11_flag_match(spark, sf):
    c = T(spark, sf, "customer").select("c_custkey")
    urgent = (T(spark, sf, "orders").where(F.col("o_orderpriority") == "1-URGENT")
              .select(F.col("o_custkey").alias("c_custkey")))
    return J.flag_match(c, urgent, ["c_custkey"], "has_urgent")


def j12_join_fill(spark, sf):
    n = T(spark, sf, "nation").select("n_nationkey", "n_name")
    c = T(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").alias("n_nationkey"))
    o = T(spark, sf, "orders").select("o_custkey", "o_totalprice")
    per = (o.join(c, o["o_custkey"] == c["c_custkey"]).groupBy("n_nationkey")
           .agg(F.sum("o_totalprice").alias("total"), F.count(F.lit(1)).cast("bigint").alias("n_orders")))
    return J.join_fill(n, per, ["n_nationkey"], "left", 0)


QUERIES = {k: v for k, v in globals().items() if k[:1] == "j" and k[1:2].isdigit() and callable(v)}

ORACLE = {
    "j1_left_join": """select c.c_custkey, c.c_mktsegment, o.o_orderkey, o.o_custkey
  from customer c left join orders o on c.c_custkey = o.o_custkey""",
    "j2_left_join_composite": W("""
with n as (select l_suppkey as entity, cast(year(l_shipdate) as int) as y, cast(month(l_shipdate) as int) as m,
  cast(count(*) as bigint) as n_returned from lineitem where l_returnflag = 'R' group by all)
select r.entity, r.y, r.m, r.ret, n.n_returned from v_returns r left join n using (entity, y, m)""", "v_returns"),
    "j3_inner_join": """select s.s_suppkey, s.s_nationkey, n.n_nationkey, n.n_name
  from supplier s join nation n on s.s_nationkey = n.n_nationkey""",
    "j4_inner_join_pairs": W("select r.entity, r.y, r.m, r.ret, f.mkt from v_returns r join v_factors f on r.y = f.y and r.m = f.m",
                             "v_returns", "v_factors"),
    "j5_outer_join": """
with f as (select o_custkey, sum(o_totalprice) as f_total from orders where o_orderstatus = 'F' group by o_custkey),
o as (select o_custkey, sum(o_totalprice) as o_total from orders where o_orderstatus = 'O' group by o_custkey)
select coalesce(f.o_custkey, o.o_custkey) as o_custkey, f.f_total, o.o_total from f full outer join o on f.o_custkey = o.o_custkey""",
    "j6_join_all": """select l_suppkey, sum(l_quantity) as qty, avg(l_extendedprice) as avg_price,
  cast(count(*) as bigint) as n_lines from lineitem group by l_suppkey""",
    "j7_join_validated": """select o.o_custkey as custkey, o.o_orderkey, c.c_nationkey
  from orders o left join customer c on o.o_custkey = c.c_custkey""",
    "j8_restrict_to": """select o_orderkey, o_custkey from orders
  where o_custkey in (select c_custkey from customer where c_mktsegment = 'BUILDING')""",
    "j9_join_then_first": """
with o as (select o_custkey, cast(year(o_orderdate) as int) as y, cast(month(o_orderdate) as int) as m,
  o_orderdate, o_orderkey, o_totalprice from orders),
mm as (select y, m, avg(o_totalprice) as month_mean from o group by y, m),
j as (select o.*, mm.month_mean, row_number() over (partition by o.o_custkey, o.y, o.m order by o.o_orderdate, o.o_orderkey) as rn
  from o join mm on o.y = mm.y and o.m = mm.m)
select y, m, o_custkey, o_orderdate, o_orderkey, o_totalprice, month_mean from j where rn = 1""",
    "j11_flag_match": """select c_custkey, case when c_custkey in (select o_custkey from orders where o_orderpriority = '1-URGENT')
  then 1 else 0 end as has_urgent from customer""",
    "j12_join_fill": """
with per as (select c.c_nationkey as n_nationkey, sum(o.o_totalprice) as total, cast(count(*) as bigint) as n_orders
  from orders o join customer c on o.o_custkey = c.c_custkey group by c.c_nationkey)
select n.n_nationkey, n.n_name, coalesce(per.total, 0) as total, coalesce(per.n_orders, 0) as n_orders
from nation n left join per on n.n_nationkey = per.n_nationkey""",
}
