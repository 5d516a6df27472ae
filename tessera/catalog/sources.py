"""Catalog: sources and sinks S1-S5."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.catalog.common import T, V, W
from tessera.session import scratch_path
from tessera.sources import files as S


def s1_read_csv(spark, sf):
    path = scratch_path(spark, "nation-csv")
    S.write_csv(T(spark, sf, "nation"), path)
    n = S.read_csv(spark, path, schema="n_nationkey int, n_name string, n_regionkey int")
    return n.groupBy("n_regionkey").agg(F.count(F.lit(1)).cast("bigint").alias("n"))


def s1_read_csv_checked(spark, sf):
    """All orders as text files of two column orders, with lines that lack a
    field, have one too many or a price that is no number."""
    path = scratch_path(spark, "orders-csv")
    o = T(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    key, status, price = F.col("o_orderkey"), F.col("o_orderstatus"), F.col("o_totalprice")
    price = F.when(key % 11 == 0, F.lit("n/a")).otherwise(price.cast("string"))
    line = F.when(key % 7 == 0, F.concat_ws(",", key, status)).when(key % 13 == 0, F.concat_ws(",", key, status, price, F.lit("x")))
    o.select(F.coalesce(line, F.concat_ws(",", key, status, price)).alias("o_orderkey,o_orderstatus,o_totalprice")).where(key % 2 == 0).write.option(
        "header", True).option("sep", "\t").csv(f"{path}/a")
    o.select(F.concat_ws(",", price, key, F.lit("c"), status).alias("o_totalprice,o_orderkey,o_more,o_orderstatus")).where(key % 2 == 1).write.option(
        "header", True).option("sep", "\t").csv(f"{path}/b")
    good, bad = S.read_csv_checked(spark, f"{path}/*", "o_orderkey bigint, o_orderstatus string, o_totalprice double")
    good = good.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").cast("bigint").alias("keys"))
    bad = bad.groupBy("reason").agg(F.count(F.lit(1)).alias("n"), F.lit(None).cast("bigint").alias("keys"))
    return good.select(F.col("o_orderstatus").alias("what"), "n", "keys").unionAll(bad.select("reason", "n", "keys"))


def s2_library(spark, sf):
    lib = S.Library(spark, sf)
    return lib.table("nation").join(lib.table("region"), F.col("n_regionkey") == F.col("r_regionkey")).select(
        "n_nationkey", "n_name", "r_name")


def s3_library_save(spark, sf):
    lib = S.Library(spark, scratch_path(spark, "library"))
    o = T(spark, sf, "orders")
    monthly = (o.groupBy(F.year("o_orderdate").cast("int").alias("y"), F.month("o_orderdate").cast("int").alias("m"))
               .agg(F.sum("o_totalprice").alias("total")))
    return lib.save(monthly, "monthly_totals", partition_by=["y"]).select("y", "m", "total")


BUCKETS = 16


def s3_library_keyed(spark, sf):
    """Orders and line items saved by order key, joined and summed without an
    exchange of either, in as many buckets as their rows ask for."""
    lib = S.Library(spark, scratch_path(spark, "library"))
    orders, items = T(spark, sf, "orders"), T(spark, sf, "lineitem")
    buckets = S.bucket_count(orders, items, least=BUCKETS)
    orders = lib.save_keyed(orders, "orders", ["o_orderkey"], buckets, parts=1)
    items = lib.save_keyed(items, "lineitem", ["l_orderkey"], buckets, parts=1)
    j = orders.join(items, F.col("o_orderkey") == F.col("l_orderkey"))
    return j.groupBy("o_orderkey").agg(F.count(F.lit(1)).alias("items"), F.sum("l_quantity").cast("double").alias("quantity"), F.first("o_orderstatus").alias("status"))


def s4_from_matrix(spark, sf):
    cost = V(spark, sf, "v_cost")
    segs = sorted(r[0] for r in V(spark, sf, "v_segments").select("segment").collect())  # 5-row dimension
    wide = cost.groupBy("product").pivot("segment", segs).agg(F.first("cost"))
    long = S.from_matrix(spark, wide, "product", "segment", "cost")
    return long.groupBy("product").agg(F.sum("cost").cast("bigint").alias("total_cost"))


def s5_normalise_missing(spark, sf):
    o = V(spark, sf, "v_orders_gaps").select(
        "o_orderkey",
        F.coalesce("price", F.lit(float("nan"))).alias("price"),
        F.coalesce("priority", F.lit("  ")).alias("priority"))
    return S.normalise_missing(o)


QUERIES = {k: v for k, v in globals().items() if k[:1] == "s" and k[1:2].isdigit() and callable(v)}

ORACLE = {
    "s1_read_csv": "select n_regionkey, cast(count(*) as bigint) as n from nation group by n_regionkey",
    "s1_read_csv_checked": """with o as (select o_orderkey, o_orderstatus, case
    when o_orderkey % 2 = 0 and (o_orderkey % 7 = 0 or o_orderkey % 13 = 0) then 'fields'
    when o_orderkey % 11 = 0 then 'o_totalprice' end as reason from orders)
  select o_orderstatus as what, count(*) as n, cast(sum(o_orderkey) as bigint) as keys from o where reason is null group by 1
  union all select reason, count(*), cast(null as bigint) from o where reason is not null group by 1""",
    "s3_library_keyed": """select o_orderkey, count(*) as items, cast(sum(l_quantity) as double) as quantity, first(o_orderstatus) as status
  from orders join lineitem on o_orderkey = l_orderkey group by o_orderkey""",
    "s2_library": "select n_nationkey, n_name, r_name from nation join region on n_regionkey = r_regionkey",
    "s3_library_save": """select cast(year(o_orderdate) as int) as y, cast(month(o_orderdate) as int) as m, sum(o_totalprice) as total
  from orders group by all""",
    "s4_from_matrix": W("select product, cast(sum(cost) as bigint) as total_cost from v_cost group by product", "v_cost"),
    "s5_normalise_missing": W("select o_orderkey, price, priority from v_orders_gaps", "v_orders_gaps"),
}
