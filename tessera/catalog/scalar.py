"""Catalog: scalar functions C1-C19."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.catalog.common import T, V, W
from tessera.functions import scalar as C

OUT_CODES = ["AB", "AD", "AX", "BC", "BD", "BX", "CB", "CX", "DB", "DX"]  # fixed values: notice codes -> "out"
IN_CODES = ["BA", "DA", "CA"]                                            # fixed values: notice codes -> "in"


def c1_parse_date(spark, sf):
    return V(spark, sf, "v_text_dates").select("id", C.parse_date("date_text").alias("d"))


def c2_to_day(spark, sf):
    return T(spark, sf, "events").select("event_id", C.to_day("ts").alias("day"))


def c3_year_month(spark, sf):
    return T(spark, sf, "orders").select("o_orderkey", C.year_of("o_orderdate").alias("year"),
                                         C.month_of("o_orderdate").alias("month"))


def c4_ym_from_text(spark, sf):
    y, m = C.ym_from_text("date_text")
    return V(spark, sf, "v_text_dates").select("id", y.alias("y"), m.alias("m"))


def c5_make_day(spark, sf):
    o = T(spark, sf, "orders")
    return o.select("o_orderkey", C.make_day(F.year("o_orderdate"), F.month("o_orderdate"), 28).alias("d"))


def c6_rebalance_year(spark, sf):
    o = T(spark, sf, "orders")
    return o.select("o_orderkey", C.rebalance_year(F.year("o_orderdate"), F.month("o_orderdate")).alias("yearr"))


def c7_fmt_day(spark, sf):
    o = T(spark, sf, "orders")
    return o.select("o_orderkey", C.fmt_day("o_orderdate").alias("day_text"),
                    C.in_yyyymm(F.year("o_orderdate"), F.month("o_orderdate"), 199601, 199812).alias("in_range"))


def c8_safe_ln(spark, sf):
    return V(spark, sf, "v_returns").select("entity", "y", "m", C.safe_ln("ret").alias("ln_ret"))


def c9_abs_diff(spark, sf):
    li = T(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber",
                     C.abs_diff(F.col("l_extendedprice") * (1 - F.col("l_discount")), "l_extendedprice").alias("gap"))


def c10_clamp0(spark, sf):
    return T(spark, sf, "customer").select("c_custkey", C.clamp0("c_acctbal").alias("balance"))


def c11_round_even(spark, sf):
    li = T(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber", C.round_even(F.col("l_quantity") / 4).alias("q4"))


def c12_pct_frac(spark, sf):
    li = T(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber", C.pct("l_discount").alias("pct"), C.frac("l_tax").alias("frac"))


def c13_recode(spark, sf):
    return V(spark, sf, "v_notices").select("notice_id", C.recode("chgtype", {"out": OUT_CODES, "in": IN_CODES}).alias("status"))


def c14_dummy(spark, sf):
    g = V(spark, sf, "v_orders_gaps")
    cond = F.col("price") >= 200000
    return g.select("o_orderkey", C.dummy(cond, 0).alias("d_sas"), C.dummy(cond, None).alias("d_r"))


def c15_band(spark, sf):
    return V(spark, sf, "v_orders_gaps").select("o_orderkey", C.band("price", [15000, 25000, 40000]).alias("band"))


def c16_zero_if_missing(spark, sf):
    return V(spark, sf, "v_orders_gaps").select("o_orderkey", C.zero_if_missing("price").alias("price"))


def c17_flow_ratio(spark, sf):
    o = T(spark, sf, "orders").withColumn("ym", F.date_trunc("month", "o_orderdate"))
    m = (o.groupBy("o_custkey", "ym")
         .agg(F.sum(F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice"))).alias("inflow"),
              F.sum(F.when(F.col("o_orderstatus") == "O", F.col("o_totalprice"))).alias("outflow"),
              F.sum("o_totalprice").alias("base")))
    return m.select("o_custkey", "ym", C.flow_ratio("inflow", "outflow", "base").alias("ratio"))


def c18_to_number(spark, sf):
    return V(spark, sf, "v_text_dates").select("id", C.to_number("key_text").alias("key"))


def c19_convert_temperature(spark, sf):
    t = V(spark, sf, "v_temps")
    return C.convert_temperature(t, "value_text", "unit").select("id", "converted", "to_unit", "reason")


QUERIES = {k: v for k, v in globals().items() if k[:1] == "c" and k[1:2].isdigit() and callable(v)}

_IN = ", ".join(f"'{c}'" for c in IN_CODES)
_OUT = ", ".join(f"'{c}'" for c in OUT_CODES)

ORACLE = {
    "c1_parse_date": W("select id, try_strptime(date_text, '%Y-%m-%d')::date as d from v_text_dates", "v_text_dates"),
    "c2_to_day": "select event_id, cast(ts as date) as day from events",
    "c3_year_month": "select o_orderkey, cast(year(o_orderdate) as int) as year, cast(month(o_orderdate) as int) as month from orders",
    "c4_ym_from_text": W("select id, try_cast(substr(date_text, 1, 4) as int) as y, try_cast(substr(date_text, 6, 2) as int) as m from v_text_dates",
                         "v_text_dates"),
    "c5_make_day": "select o_orderkey, make_date(year(o_orderdate)::int, month(o_orderdate)::int, 28) as d from orders",
    "c6_rebalance_year": """select o_orderkey, cast(case when month(o_orderdate) >= 5 then year(o_orderdate) else year(o_orderdate) - 1 end as int)
  as yearr from orders""",
    "c7_fmt_day": """select o_orderkey, strftime(o_orderdate, '%Y%m%d') as day_text,
  (year(o_orderdate) * 100 + month(o_orderdate)) between 199601 and 199812 as in_range from orders""",
    "c8_safe_ln": W("select entity, y, m, case when ret > 0 then ln(ret) end as ln_ret from v_returns", "v_returns"),
    "c9_abs_diff": "select l_orderkey, l_linenumber, abs(l_extendedprice * (1 - l_discount) - l_extendedprice) as gap from lineitem",
    "c10_clamp0": "select c_custkey, case when c_acctbal >= 0 then c_acctbal else 0 end as balance from customer",
    "c11_round_even": "select l_orderkey, l_linenumber, round_even(l_quantity / 4, 0) as q4 from lineitem",
    "c12_pct_frac": "select l_orderkey, l_linenumber, l_discount * 100 as pct, l_tax / 100 as frac from lineitem",
    "c13_recode": W(f"""select notice_id, case when chgtype in ({_OUT}) then 'out' when chgtype in ({_IN}) then 'in' end as status
  from v_notices""", "v_notices"),
    "c14_dummy": W("""select o_orderkey, case when price >= 200000 then 1 else 0 end as d_sas,
  case when price >= 200000 then 1 when price < 200000 then 0 end as d_r from v_orders_gaps""", "v_orders_gaps"),
    "c15_band": W("""select o_orderkey, case when price <= 15000 then 1 when price <= 25000 then 2 when price <= 40000 then 3
  when price is not null then 4 end as band from v_orders_gaps""", "v_orders_gaps"),
    "c16_zero_if_missing": W("select o_orderkey, coalesce(price, 0) as price from v_orders_gaps", "v_orders_gaps"),
    "c17_flow_ratio": """with m as (select o_custkey, date_trunc('month', o_orderdate) as ym,
  sum(case when o_orderstatus = 'F' then o_totalprice end) as inflow, sum(case when o_orderstatus = 'O' then o_totalprice end) as outflow,
  sum(o_totalprice) as base from orders group by all)
select o_custkey, ym, case when base <> 0 then abs(coalesce(inflow, 0) - coalesce(outflow, 0)) / base end as ratio from m""",
    "c18_to_number": W("select id, try_cast(key_text as bigint) as key from v_text_dates", "v_text_dates"),
    "c19_convert_temperature": W("""with t as (select id, try_cast(value_text as double) as v, upper(trim(unit)) as u from v_temps)
select id, case when v is not null and u = 'C' then (9 * v + 160) / 5 when v is not null and u = 'F' then (5 * v - 160) / 9 end as converted,
  case when v is not null and u in ('C', 'F') then case when u = 'C' then 'F' else 'C' end end as to_unit,
  case when v is not null and u in ('C', 'F') then 'ok' when v is not null then 'bad unit' when u in ('C', 'F') then 'bad value'
  else 'bad value and unit' end as reason from t""", "v_temps"),
}
