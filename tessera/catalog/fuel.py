"""Catalog: fuel jobs D1-D6 and the operators they exercise."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.catalog.common import V, W
from tessera.operators import aggregate as A
from tessera.operators import joins as J
from tessera.operators import ordered as O
from tessera.plans import fuel

FUEL_VIEWS = ("v_readings", "v_tanks", "v_purchases", "v_sites")


def _daily(spark, sf):
    return fuel.daily_consumption(V(spark, sf, "v_readings"), V(spark, sf, "v_tanks"),
                                  V(spark, sf, "v_purchases"), V(spark, sf, "v_sites"))


def d1_daily_consumption(spark, sf):
    return _daily(spark, sf)


def d2_site_mix(spark, sf):
    return fuel.site_mix(_daily(spark, sf))


def a8_avg_per_period(spark, sf):
    return fuel.site_daily_average(_daily(spark, sf))


def d3_monthly_joint(spark, sf):
    return fuel.monthly_joint(_daily(spark, sf), V(spark, sf, "v_purchases"))


def d4_site_corr(spark, sf):
    return fuel.site_corr(fuel.monthly_joint(_daily(spark, sf), V(spark, sf, "v_purchases")))


def d5_seasonal_profile(spark, sf):
    return fuel.seasonal_profile(V(spark, sf, "v_purchases"))


def d5_seasonal_profile_year(spark, sf):
    return fuel.seasonal_profile(V(spark, sf, "v_purchases"), year=2024)


def d6_discount_mix(spark, sf):
    p = V(spark, sf, "v_purchases").withColumn("amount", F.col("amount") * 50)
    return fuel.discount_mix(p)


def a6_first_minus_last(spark, sf):
    r = V(spark, sf, "v_readings").withColumn("day", F.col("ts").cast("date"))
    return A.first_minus_last(r, ["tank_id", "day"], "fuel_level", "ts")


def a7_rollup_units(spark, sf):
    r = (V(spark, sf, "v_readings").join(V(spark, sf, "v_tanks"), "tank_id")
         .withColumn("day", F.col("ts").cast("date")))
    return A.rollup_units(r, ["tank_type", "day", "tank_id"], ["tank_type", "day"], "fuel_level", "ts")


def w11_period_number(spark, sf):
    r = V(spark, sf, "v_readings").withColumn("day", F.col("ts").cast("date"))
    return O.period_number(r, "day").select("tank_id", "ts", "date_number")


def j10_map_values(spark, sf):
    p = V(spark, sf, "v_purchases")
    r = V(spark, sf, "v_readings").select(F.col("ts").cast("date").alias("day")).distinct()
    cal = O.period_number(r, "day")
    return J.map_values(p, "invoice_date", cal, "day", "date_number").select("invoice_id", "date_number")


QUERIES = {
    "d1_daily_consumption": d1_daily_consumption,
    "d2_site_mix": d2_site_mix,
    "a8_avg_per_period": a8_avg_per_period,
    "d3_monthly_joint": d3_monthly_joint,
    "d4_site_corr": d4_site_corr,
    "d5_seasonal_profile": d5_seasonal_profile,
    "d5_seasonal_profile_year": d5_seasonal_profile_year,
    "d6_discount_mix": d6_discount_mix,
    "a6_first_minus_last": a6_first_minus_last,
    "a7_rollup_units": a7_rollup_units,
    "w11_period_number": w11_period_number,
    "j10_map_values": j10_map_values,
}

_D1 = """
r as (select r.tank_id, r.ts, r.fuel_level, t.location, t.tank_type, cast(r.ts as date) as day
      from v_readings r left join v_tanks t on r.tank_id = t.tank_id where r.fuel_level is not null),
cal as (select day, cast(dense_rank() over (order by day) as int) as date_number from (select distinct day from r) x),
unit as (select day, tank_id, location, tank_type, arg_min(fuel_level, ts) - arg_max(fuel_level, ts) as delta
         from r where location is not null group by day, tank_id, location, tank_type),
site as (select day, location,
           sum(case when tank_type in ('U','P') then delta end) as gas_consumption,
           sum(case when tank_type = 'D' then delta end) as diesel_consumption,
           count(case when tank_type in ('U','P') then 1 end) as n_gas,
           count(case when tank_type = 'D' then 1 end) as n_dsl
         from unit group by day, location),
p as (select invoice_date as day, location,
        sum(case when fuel_type = 'G' then amount end) as gas_purchased,
        sum(case when fuel_type = 'D' then amount end) as diesel_purchased
      from v_purchases where invoice_date in (select day from cal) and location is not null
      group by invoice_date, location),
j as (select s.day, s.location, s.gas_consumption, coalesce(p.gas_purchased, 0) as gas_purchased,
        case when s.n_dsl > 0 then s.diesel_consumption end as diesel_consumption,
        case when s.n_dsl > 0 then coalesce(p.diesel_purchased, 0) end as diesel_purchased
      from site s left join p on s.day = p.day and s.location = p.location where s.n_gas > 0),
daily as (
  select c.date_number, c.day, j.location, st.site_name, j.gas_consumption, j.gas_purchased,
    case when j.gas_consumption + j.gas_purchased >= 0 then j.gas_consumption + j.gas_purchased else 0 end as gas_total,
    j.diesel_consumption, j.diesel_purchased,
    case when j.diesel_consumption + j.diesel_purchased >= 0 then j.diesel_consumption + j.diesel_purchased else 0 end as diesel_total
  from j full outer join cal c on j.day = c.day left join v_sites st on j.location = st.location)"""


def _with_daily(body: str) -> str:
    # the fixture CTEs come first, then the daily-consumption CTEs
    w = W("select 1", *FUEL_VIEWS)
    head = w[: w.rindex("\nselect 1")]
    return f"{head},\n{_D1.strip()}\n{body.strip()}"


_JOINT = """, cons as (select location, cast(month(day) as int) as month, cast(year(day) as int) as year,
  coalesce(sum(gas_total), 0) as gas_total, coalesce(sum(diesel_total), 0) as diesel_total
  from daily where location is not null group by all),
pur as (select location, cast(month(invoice_date) as int) as month, cast(year(invoice_date) as int) as year,
  sum(case when fuel_type = 'G' then cost end) as gas_cost, sum(case when fuel_type = 'G' then amount end) as gas_amount,
  sum(case when fuel_type = 'D' then cost end) as diesel_cost, sum(case when fuel_type = 'D' then amount end) as diesel_amount
  from v_purchases where location is not null group by all),
joint as (select c.location, c.month, c.year, c.gas_total, c.diesel_total,
  coalesce(p.gas_cost, 0) as gas_cost, coalesce(p.gas_amount, 0) as gas_amount,
  coalesce(p.diesel_cost, 0) as diesel_cost, coalesce(p.diesel_amount, 0) as diesel_amount
  from cons c left join pur p on c.location = p.location and c.month = p.month and c.year = p.year)
"""

ORACLE = {
    "d1_daily_consumption": _with_daily("select * from daily"),
    "d2_site_mix": _with_daily("""
, t as (select location, site_name, coalesce(sum(gas_total), 0) as gas_total, coalesce(sum(diesel_total), 0) as diesel_total
  from daily where location is not null and site_name is not null group by location, site_name)
select location, site_name, gas_total, diesel_total, gas_total + diesel_total as total,
  case when gas_total + diesel_total <> 0 then gas_total / (gas_total + diesel_total) end as gas_share,
  case when gas_total + diesel_total <> 0 then diesel_total / (gas_total + diesel_total) end as diesel_share from t"""),
    "a8_avg_per_period": _with_daily("""
select location, round_even(coalesce(sum(gas_total), 0) / (select max(date_number) from daily), 0) as avg_gas,
  round_even(coalesce(sum(diesel_total), 0) / (select max(date_number) from daily), 0) as avg_diesel
from daily where location is not null group by location"""),
    "d3_monthly_joint": _with_daily(_JOINT + "select * from joint"),
    "d4_site_corr": _with_daily(_JOINT + """
, g as (select location,
  case when stddev_samp(gas_total) * stddev_samp(gas_cost) <> 0 then covar_samp(gas_total, gas_cost) / (stddev_samp(gas_total) * stddev_samp(gas_cost)) end as Gas,
  case when stddev_samp(diesel_total) * stddev_samp(diesel_cost) <> 0 then covar_samp(diesel_total, diesel_cost) / (stddev_samp(diesel_total) * stddev_samp(diesel_cost)) end as Diesel
  from joint group by location)
select location, 'Gas' as fuel, Gas as r from g union all select location, 'Diesel' as fuel, Diesel as r from g"""),
    "d5_seasonal_profile": W("""
select cast(month(invoice_date) as int) as month, fuel_type, location, coalesce(sum(amount), 0) as amount
from v_purchases where location is not null and invoice_date is not null group by all""", "v_purchases"),
    "d5_seasonal_profile_year": W("""
select cast(month(invoice_date) as int) as month, fuel_type, location, coalesce(sum(amount), 0) as amount
from v_purchases where location is not null and invoice_date is not null and year(invoice_date) = 2024 group by all""",
                                  "v_purchases"),
    "d6_discount_mix": W("""
with p as (select location, fuel_type, amount * 50 as amount from v_purchases where location is not null),
b as (select location, fuel_type, case when amount <= 15000 then 1 when amount <= 25000 then 2
        when amount <= 40000 then 3 when amount is not null then 4 end as band from p),
grid as (select l.location, f.fuel_type, k.band from (select distinct location from p) l,
         (values ('D'), ('G')) f(fuel_type), (values (1), (2), (3), (4)) k(band)),
tot as (select location, fuel_type, count(*) as tot from b group by all),
cnt as (select location, fuel_type, band, count(*) as n from b group by all)
select g.location, g.fuel_type, g.band, coalesce(c.n, 0) * 100.0 / t.tot as percent
from grid g left join tot t on g.location = t.location and g.fuel_type = t.fuel_type
left join cnt c on g.location = c.location and g.fuel_type = c.fuel_type and g.band = c.band""", "v_purchases"),
    "a6_first_minus_last": W("""
select tank_id, cast(ts as date) as day, arg_min(fuel_level, ts) - arg_max(fuel_level, ts) as delta
from v_readings where fuel_level is not null group by tank_id, cast(ts as date)""", "v_readings"),
    "a7_rollup_units": W("""
with u as (select t.tank_type, cast(r.ts as date) as day, r.tank_id,
  arg_min(r.fuel_level, r.ts) - arg_max(r.fuel_level, r.ts) as delta
  from v_readings r join v_tanks t on r.tank_id = t.tank_id where r.fuel_level is not null group by all)
select tank_type, day, coalesce(sum(delta), 0) as delta from u group by tank_type, day""", "v_readings", "v_tanks"),
    "w11_period_number": W("""
select tank_id, ts, cast(dense_rank() over (order by cast(ts as date)) as int) as date_number from v_readings""",
                           "v_readings"),
    "j10_map_values": W("""
with cal as (select day, cast(dense_rank() over (order by day) as int) as date_number
  from (select distinct cast(ts as date) as day from v_readings) x)
select p.invoice_id, c.date_number from v_purchases p left join cal c on p.invoice_date = c.day""",
                        "v_readings", "v_purchases"),
}
