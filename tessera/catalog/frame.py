"""Catalog: projection P1-P7, filters F1-F10, sort/dedup/append O1-O5."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.catalog.common import T, V, W
from tessera.operators import frame as Fr


def p1_rename(spark, sf):
    return Fr.rename(T(spark, sf, "customer"), {"c_custkey": "cust_id", "c_name": "name", "c_acctbal": "balance"})


def p2_keep(spark, sf):
    return Fr.keep(T(spark, sf, "orders"), ["o_orderkey", "o_custkey", "o_totalprice"])


def p3_drop(spark, sf):
    return Fr.drop(T(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus", "l_shipdate", "l_partkey"])


def p4_reorder(spark, sf):
    return Fr.reorder(T(spark, sf, "part"), ["p_size", "p_brand"])


def p5_derive(spark, sf):
    li = T(spark, sf, "lineitem")
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return Fr.derive(li.select("l_orderkey", "l_linenumber", "l_extendedprice", "l_discount", "l_tax"),
                     net_price=net, gross_price=net * (1 + F.col("l_tax")))


def p6_select_dtypes(spark, sf):
    num = Fr.select_dtypes(T(spark, sf, "lineitem"), ["numeric"])
    return num.agg(*[F.sum(c).alias(f"sum_{c}") for c in num.columns])


def p7_join_select(spark, sf):
    a = T(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("custkey"),
                                      F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("amount"))
    b = T(spark, sf, "customer").select(F.col("c_custkey").alias("custkey"), F.col("c_mktsegment").alias("status"),
                                        F.col("c_acctbal").alias("amount"), "c_name")
    return Fr.join_select(a, b, ["custkey"])


def f1_filter_eq(spark, sf):
    return Fr.filter_eq(T(spark, sf, "orders"), "o_orderstatus", "F").select("o_orderkey", "o_totalprice")


def f2_filter_in(spark, sf):
    return Fr.filter_in(T(spark, sf, "orders"), "o_orderpriority", ["1-URGENT", "2-HIGH"]).select("o_orderkey")


def f3_filter_not_in(spark, sf):
    return Fr.filter_not_in(V(spark, sf, "v_orders_gaps"), "priority", ["1-URGENT", "2-HIGH"]).select(
        "o_orderkey", "priority")


def f4_filter_between(spark, sf):
    o = T(spark, sf, "orders").withColumn("year", F.year("o_orderdate").cast("int"))
    return Fr.filter_between(o, 1996, "year", 1998).select("o_orderkey", "year")


def f5_dropna_any(spark, sf):
    return Fr.dropna_any(V(spark, sf, "v_orders_gaps"), ["price", "priority"]).select("o_orderkey", "price", "priority")


def f6_drop_at_or_below(spark, sf):
    return Fr.drop_at_or_below(V(spark, sf, "v_orders_gaps"), "price", 100000).select("o_orderkey", "price")


def f7_delete_if(spark, sf):
    return Fr.delete_if(V(spark, sf, "v_orders_gaps"), F.col("price") > 200000).select("o_orderkey", "price")


def f8_drop_last(spark, sf):
    return Fr.drop_last(T(spark, sf, "nation"), ["n_nationkey"], 1)


def f9_slice_from(spark, sf):
    return Fr.slice_from(V(spark, sf, "v_returns"), "m", 7).select("entity", "y", "m")


def f10_count_negative(spark, sf):
    return Fr.count_negative(T(spark, sf, "customer"), ["c_acctbal"])


def o1_sort(spark, sf):
    return Fr.sort(T(spark, sf, "orders").select("o_orderkey", "o_totalprice"),
                   [F.col("o_totalprice").desc(), "o_orderkey"])


def o2_first_per_key(spark, sf):
    o = T(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    return Fr.first_per_key(o, ["o_custkey"], [("o_orderdate", False), ("o_orderkey", False)])


def o2_first_per_key_mixed(spark, sf):
    o = T(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    return Fr.first_per_key(o, ["o_custkey"], [("o_totalprice", False), ("o_orderkey", True)])


def o3_duplicate_count(spark, sf):
    return Fr.duplicate_count(T(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


def o3_dedup(spark, sf):
    return Fr.dedup(T(spark, sf, "lineitem").select("l_orderkey", "l_linenumber"))


def o4_head(spark, sf):
    return Fr.head(T(spark, sf, "orders").select("o_orderkey", "o_totalprice"), 10,
                   [F.col("o_totalprice").desc(), "o_orderkey"])


def o5_append(spark, sf):
    o = T(spark, sf, "orders")
    a = o.where(F.col("o_orderstatus") == "F").select("o_orderkey", "o_totalprice")
    b = o.where(F.col("o_orderstatus") != "F").select("o_orderkey", F.col("o_totalprice").alias("price"),
                                                      "o_orderstatus")
    return Fr.append(a, b, rename={"price": "o_totalprice"})


QUERIES = {k: v for k, v in globals().items() if k[:1] in "pfo" and k[1:2].isdigit() and callable(v)}

ORACLE = {
    "p1_rename": "select c_custkey as cust_id, c_name as name, c_nationkey, c_acctbal as balance, c_mktsegment from customer",
    "p2_keep": "select o_orderkey, o_custkey, o_totalprice from orders",
    "p3_drop": "select l_orderkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax from lineitem",
    "p4_reorder": "select p_size, p_brand, p_partkey, p_name, p_type, p_retailprice from part",
    "p5_derive": """select l_orderkey, l_linenumber, l_extendedprice, l_discount, l_tax,
  l_extendedprice * (1 - l_discount) as net_price, l_extendedprice * (1 - l_discount) * (1 + l_tax) as gross_price from lineitem""",
    "p6_select_dtypes": """select cast(sum(l_orderkey) as bigint) as sum_l_orderkey, cast(sum(l_partkey) as bigint) as sum_l_partkey,
  cast(sum(l_suppkey) as bigint) as sum_l_suppkey, cast(sum(l_linenumber) as bigint) as sum_l_linenumber,
  sum(l_quantity) as sum_l_quantity, sum(l_extendedprice) as sum_l_extendedprice, sum(l_discount) as sum_l_discount,
  sum(l_tax) as sum_l_tax from lineitem""",
    "p7_join_select": """select o.o_orderkey, o.o_custkey as custkey, o.o_orderstatus as status, o.o_totalprice as amount, c.c_name
  from orders o join customer c on o.o_custkey = c.c_custkey""",
    "f1_filter_eq": "select o_orderkey, o_totalprice from orders where o_orderstatus = 'F'",
    "f2_filter_in": "select o_orderkey from orders where o_orderpriority in ('1-URGENT', '2-HIGH')",
    "f3_filter_not_in": W("select o_orderkey, priority from v_orders_gaps where priority not in ('1-URGENT', '2-HIGH') or priority is null",
                          "v_orders_gaps"),
    "f4_filter_between": "select o_orderkey, cast(year(o_orderdate) as int) as year from orders where year(o_orderdate) between 1996 and 1998",
    "f5_dropna_any": W("select o_orderkey, price, priority from v_orders_gaps where price is not null and priority is not null",
                       "v_orders_gaps"),
    "f6_drop_at_or_below": W("select o_orderkey, price from v_orders_gaps where price > 100000", "v_orders_gaps"),
    "f7_delete_if": W("select o_orderkey, price from v_orders_gaps where not coalesce(price > 200000, false)", "v_orders_gaps"),
    "f8_drop_last": "select * from nation where n_nationkey <> (select max(n_nationkey) from nation)",
    "f9_slice_from": W("select entity, y, m from v_returns where m >= 7", "v_returns"),
    "f10_count_negative": "select cast(count(*) filter (where c_acctbal < 0) as bigint) as c_acctbal from customer",
    "o1_sort": "select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey",
    "o2_first_per_key": """select o_custkey, o_orderkey, o_orderdate, o_totalprice from (
  select *, row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) as rn from orders) where rn = 1""",
    "o2_first_per_key_mixed": """select o_custkey, o_orderkey, o_orderdate, o_totalprice from (
  select *, row_number() over (partition by o_custkey order by o_totalprice desc, o_orderkey asc) as rn from orders) where rn = 1""",
    "o3_duplicate_count": """select cast(count(*) as bigint) as rows,
  cast((select count(*) from (select distinct l_orderkey, l_linenumber from lineitem)) as bigint) as distinct_rows,
  cast(count(*) - (select count(*) from (select distinct l_orderkey, l_linenumber from lineitem)) as bigint) as duplicates from lineitem""",
    "o3_dedup": "select distinct l_orderkey, l_linenumber from lineitem",
    "o4_head": "select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 10",
    "o5_append": """select o_orderkey, o_totalprice, null as o_orderstatus from orders where o_orderstatus = 'F'
  union all select o_orderkey, o_totalprice, o_orderstatus from orders where o_orderstatus <> 'F'""",
}
