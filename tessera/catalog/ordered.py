"""Catalog: windows and ordered time series W1-W13 (W11 is in the fuel catalog)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.catalog.common import T, V, W
from tessera.operators import ordered as O


def _events(spark, sf):
    return T(spark, sf, "events").select("user_id", "ts", "event_id", "event_type", "value")


def _flagged(spark, sf):
    e = _events(spark, sf)
    return e.withColumn("flag", F.when(F.col("event_type") == "purchase", F.lit("out"))
                        .when(F.col("event_type") == "view", F.lit("in")))


def w1_lag_by(spark, sf):
    return O.lag_by(_events(spark, sf), "user_id", "ts", "value").select("user_id", "ts", "value", "value_lag1")


def w2_lag2(spark, sf):
    return O.lag_by(_events(spark, sf), "user_id", "ts", "value", n=2).select("user_id", "ts", "value_lag2")


def w3_lag_no_reset(spark, sf):
    return O.lag_by(_events(spark, sf), "user_id", "ts", "value", reset=False).select("user_id", "ts", "value_lag1")


def w4_ffill_first(spark, sf):
    return O.ffill(_flagged(spark, sf), "user_id", "ts", "flag", first="in").select("user_id", "ts", "flag_filled")


def w5_ffill(spark, sf):
    return O.ffill(_flagged(spark, sf), "user_id", "ts", "flag").select("user_id", "ts", "flag_filled")


def w6_status_effective(spark, sf):
    return O.status_effective(_flagged(spark, sf), "user_id", "ts", "flag").select(
        "user_id", "ts", "flag_filled", "decision")


def w7_log_return(spark, sf):
    return O.log_return(V(spark, sf, "v_nav_daily"), "fund_text", "d", "nav").select("fund_text", "d", "nav_logret")


def w8_lagged_growth(spark, sf):
    return O.lagged_growth(V(spark, sf, "v_statements"), "entity", "y", "spend").select(
        "entity", "y", "spend_l1", "spend_l2", "growth")


def w9_lag_filter_before(spark, sf):
    return O.lag_by(V(spark, sf, "v_returns"), "entity", ["y", "m"], "ret", where=F.col("mv") > 100000,
                    when="before").select("entity", "y", "m", "ret_lag1")


def w9_lag_filter_after(spark, sf):
    return O.lag_by(V(spark, sf, "v_returns"), "entity", ["y", "m"], "ret", where=F.col("mv") > 100000,
                    when="after").select("entity", "y", "m", "ret_lag1")


def w10_first_flag(spark, sf):
    o = T(spark, sf, "orders").select("o_custkey", "o_orderdate", "o_orderkey")
    return O.first_flag(o, "o_custkey", ["o_orderdate", "o_orderkey"])


def w12_quantile_groups_ntile(spark, sf):
    return O.quantile_groups(V(spark, sf, "v_returns"), "y", "ret", 10, "ntile",
                             tiebreak=["entity", "m"]).select("entity", "y", "m", "grp")


def w12_quantile_groups_rank(spark, sf):
    return O.quantile_groups(V(spark, sf, "v_returns"), "y", "ret", 5, "rank").select("entity", "y", "m", "grp")


def w13_winsorize(spark, sf):
    o = T(spark, sf, "orders").withColumn("year", F.year("o_orderdate").cast("int")).select(
        "o_orderkey", "year", "o_totalprice")
    return O.winsorize(o, "year", "o_totalprice", 0.01)


QUERIES = {k: v for k, v in globals().items() if k[:1] == "w" and k[1:2].isdigit() and callable(v)}

_FLAG = """e as (select user_id, ts, event_id, event_type, value,
  case when event_type = 'purchase' then 'out' when event_type = 'view' then 'in' end as flag from events)"""

ORACLE = {
    "w1_lag_by": "select user_id, ts, value, lag(value) over (partition by user_id order by ts) as value_lag1 from events",
    "w2_lag2": "select user_id, ts, lag(value, 2) over (partition by user_id order by ts) as value_lag2 from events",
    "w3_lag_no_reset": "select user_id, ts, lag(value) over (order by user_id, ts) as value_lag1 from events",
    "w4_ffill_first": f"""with {_FLAG},
f as (select *, case when row_number() over (partition by user_id order by ts) = 1 then 'in' else flag end as v from e)
select user_id, ts, last_value(v ignore nulls) over (partition by user_id order by ts rows between unbounded preceding and current row)
  as flag_filled from f""",
    "w5_ffill": f"""with {_FLAG}
select user_id, ts, last_value(flag ignore nulls) over (partition by user_id order by ts rows between unbounded preceding and current row)
  as flag_filled from e""",
    "w6_status_effective": f"""with {_FLAG},
f as (select *, case when row_number() over (partition by user_id order by ts) = 1 then 'in' else flag end as v from e),
g as (select user_id, ts, last_value(v ignore nulls) over (partition by user_id order by ts rows between unbounded preceding and current row)
  as flag_filled from f)
select user_id, ts, flag_filled, coalesce(lag(flag_filled) over (partition by user_id order by ts), 'in') as decision from g""",
    "w7_log_return": W("""select fund_text, d, case when nav / lag(nav) over (partition by fund_text order by d) > 0
  then ln(nav / lag(nav) over (partition by fund_text order by d)) end as nav_logret from v_nav_daily""", "v_nav_daily"),
    "w8_lagged_growth": W("""with l as (select entity, y, lag(spend, 1) over (partition by entity order by y) as spend_l1,
  lag(spend, 2) over (partition by entity order by y) as spend_l2 from v_statements)
select entity, y, spend_l1, spend_l2, case when spend_l1 <> 0 then (spend_l1 - spend_l2) / spend_l1 end as growth from l""",
                          "v_statements"),
    "w9_lag_filter_before": W("""select entity, y, m, lag(ret) over (partition by entity order by y, m) as ret_lag1
  from v_returns where mv > 100000""", "v_returns"),
    "w9_lag_filter_after": W("""select entity, y, m, ret_lag1 from (select *, lag(ret) over (partition by entity order by y, m) as ret_lag1
  from v_returns) where mv > 100000""", "v_returns"),
    "w10_first_flag": """select o_custkey, o_orderdate, o_orderkey,
  cast(row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) = 1 as int) as first from orders""",
    "w12_quantile_groups_ntile": W("""select entity, y, m, cast(ntile(10) over (partition by y order by ret, entity, m) as int) as grp
  from v_returns where ret is not null""", "v_returns"),
    "w12_quantile_groups_rank": W("""select entity, y, m, cast(floor((rank() over (partition by y order by ret)
  + (count(*) over (partition by y, ret) - 1) / 2.0) * 5 / (count(*) over (partition by y) + 1)) + 1 as int) as grp
  from v_returns where ret is not null""", "v_returns"),
    "w13_winsorize": """with b as (select cast(year(o_orderdate) as int) as year, quantile_cont(o_totalprice, 0.01) as lo,
  quantile_cont(o_totalprice, 0.99) as hi from orders group by all)
select o.o_orderkey, b.year, o.o_totalprice, least(greatest(o.o_totalprice, b.lo), b.hi) as o_totalprice_w
from orders o join b on cast(year(o.o_orderdate) as int) = b.year""",
}
