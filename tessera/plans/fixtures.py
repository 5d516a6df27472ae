"""Bindings of the operators to the driver tables (FIXTURES.md section 3).

Each view is plain SQL valid in both Spark and DuckDB, so the same text
serves the Spark side (``fixture``) and the oracle side (``with_views``).
All views are derived from the driver tables, so their size grows with them.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = ("region nation customer supplier part orders lineitem events "
               "documents embeddings pages benchmark labels conversations").split()

VIEWS: dict[str, str] = {
    "v_orders_gaps": """
select o_orderkey, o_custkey, o_orderstatus, o_orderdate,
  case when o_orderkey % 7 = 0 then null else o_totalprice end as price,
  case when o_orderkey % 11 = 0 then null else o_orderpriority end as priority
from orders""",
    "v_tanks": """
select distinct user_id as tank_id, cast(user_id % 8 + 1 as int) as location,
  case when user_id % 3 = 0 then 'D' when user_id % 3 = 1 then 'U' else 'P' end as tank_type
from events""",
    "v_readings": """
select user_id as tank_id, ts, case when event_id % 13 = 0 then null else value end as fuel_level
from events where event_type <> 'purchase'""",
    "v_purchases": """
select event_id as invoice_id, cast(ts as date) as invoice_date, cast(user_id % 8 + 1 as int) as location,
  case when event_id % 2 = 0 then 'G' else 'D' end as fuel_type,
  value * 100 as amount, value * 90 as cost
from events where event_type = 'purchase'""",
    "v_sites": """
select n_nationkey as location, n_name as site_name from nation where n_nationkey between 1 and 8""",
    "v_returns": """
select l_suppkey as entity, cast(year(l_shipdate) as int) as y, cast(month(l_shipdate) as int) as m,
  cast(sum(cast(l_discount as decimal(18,2))) as double) / count(*) - 0.05 as ret,
  cast(sum(cast(l_extendedprice as decimal(18,2))) as double) as mv
from lineitem group by l_suppkey, year(l_shipdate), month(l_shipdate)""",
    "v_factors": """
select cast(year(l_shipdate) as int) as y, cast(month(l_shipdate) as int) as m,
  cast(sum(cast(l_discount as decimal(18,2))) as double) / count(*) - 0.05 as mkt,
  cast(sum(cast(l_tax as decimal(18,2))) as double) / count(*) - 0.04 as smb,
  cast(sum(cast(l_quantity as decimal(18,2))) as double) / count(*) / 1000 - 0.025 as hml,
  cast(0.001 as double) as rf
from lineitem group by year(l_shipdate), month(l_shipdate)""",
    "v_nav_daily": """
select lpad(cast(l_suppkey % 10 as varchar(6)), 6, '0') as fund_text, cast(l_shipdate as date) as d,
  cast(sum(cast(l_extendedprice as decimal(18,2))) as double) / count(*) as nav,
  cast(sum(cast(l_discount as decimal(18,2))) as double) / count(*) as fund_return_pct
from lineitem group by l_suppkey % 10, cast(l_shipdate as date)""",
    "v_index_monthly": """
select cast(e.code as bigint) as code, f.y, f.m, f.mkt + e.code * 0.0001 as idx_return
from v_factors f join (select distinct l_suppkey % 10 as code, cast(year(l_shipdate) as int) as y, cast(month(l_shipdate) as int) as m from lineitem) e
  on f.y = e.y and f.m = e.m""",
    "v_notices": """
select o_orderkey as notice_id, o_custkey % 100 as entity, cast(o_orderdate as date) as notice_date,
  case o_orderpriority when '1-URGENT' then 'AB' when '5-LOW' then 'BA' else 'ZZ' end as chgtype
from orders""",
    "v_statements": """
select o_custkey as entity, cast(year(o_orderdate) as int) as y, 12 as m,
  cast(sum(cast(o_totalprice as decimal(18,2))) as double) as spend, max(c_acctbal) + 2000 as cap
from orders join customer on o_custkey = c_custkey group by o_custkey, year(o_orderdate)""",
    "v_brand_month": """
select p_brand as brand, cast(year(l_shipdate) as int) as y, cast(month(l_shipdate) as int) as m,
  cast(sum(cast(l_extendedprice as decimal(18,2))) as double) / cast(sum(cast(l_quantity as decimal(18,2))) as double) as price,
  cast(sum(cast(l_quantity as decimal(18,2))) as double) as units,
  cast(month(l_shipdate) % 3 as int) as sale
from lineitem join part on l_partkey = p_partkey
group by p_brand, year(l_shipdate), month(l_shipdate)""",
    "v_products": """
select p_partkey as product, p_name as product_name, p_size as base_cost from part""",
    "v_segments": """
select c_mktsegment as segment, cast(row_number() over (order by c_mktsegment) as int) as seg_no, count(*) as n from customer group by c_mktsegment""",
    "v_cost": """
select p.product, s.segment, s.n, case when (p.product + s.seg_no) % 7 = 0 then 100 else p.base_cost end as cost
from v_products p
join (select distinct l_partkey as product, c_mktsegment as segment from lineitem join orders on l_orderkey = o_orderkey
  join customer on o_custkey = c_custkey) b on p.product = b.product join v_segments s on b.segment = s.segment""",
    "v_plan_x": """
select product, cast(floor(product / 5.0) + 1 as int) as box from v_products""",
    "v_plan_y": """
select segment, cast(seg_no % 3 + 1 as int) as box from v_segments""",
    "v_labelled": """
select l.doc_id, d.n_chars, cast(length(d.text) - length(replace(d.text, ' ', '')) as int) as spaces, d.lang, l.quality as label
from labels l join documents d on l.doc_id = d.doc_id""",
    "v_part_gaps": """
select p_partkey as id, case when p_partkey % 17 = 0 then null else cast(p_size as double) end as f1,
  case when p_partkey % 19 = 0 then null else p_retailprice end as f2 from part""",
    "v_text_dates": """
select o_orderkey as id, concat(cast(year(o_orderdate) as varchar(4)), '-', lpad(cast(month(o_orderdate) as varchar(2)), 2, '0'), '-', lpad(cast(day(o_orderdate) as varchar(2)), 2, '0')) as date_text,
  case when o_orderkey % 23 = 0 then 'n/a' else lpad(cast(o_custkey as varchar(8)), 8, '0') end as key_text
from orders""",
    "v_temps": """
select event_id as id, case when event_id % 29 = 0 then 'abc' else cast(cast(round(value) as int) as varchar(10)) end as value_text,
  case event_id % 3 when 0 then 'C' when 1 then 'F' else 'K' end as unit
from events""",
}

_NAME = re.compile(r"\b(v_[a-z_]+|" + "|".join(BASE_TABLES) + r")\b")


def _deps(name: str) -> list[str]:
    """Views a view needs, dependencies first."""
    out: list[str] = []
    for ref in _NAME.findall(VIEWS[name]):
        if ref in VIEWS and ref != name:
            for d in _deps(ref) + [ref]:
                if d not in out:
                    out.append(d)
    return out


def with_views(sql: str, *names: str) -> str:
    """Prefix ``sql`` with the CTEs of the named fixture views (and their
    dependencies) so that it runs on the base tables alone."""
    order: list[str] = []
    for n in names:
        for d in _deps(n) + [n]:
            if d not in order:
                order.append(d)
    if not order:
        return sql
    ctes = ",\n".join(f"{n} as ({VIEWS[n].strip()})" for n in order)
    body = sql.strip()
    if body[:5].lower() == "with ":
        return f"with {ctes},\n{body[5:]}"
    return f"with {ctes}\n{body}"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one driver table; Parquet scan with pruning and pushdown."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def register_base(spark: SparkSession, sf_dir: str, names=BASE_TABLES) -> None:
    for n in names:
        load(spark, sf_dir, n).createOrReplaceTempView(n)


def sql(spark: SparkSession, sf_dir: str, text: str, *views: str) -> DataFrame:
    """Run Spark SQL over the driver tables of ``sf_dir`` and fixture views.

    Table names are bound at analysis time, so the returned DataFrame keeps
    reading ``sf_dir`` even if the views are re-registered later.
    """
    used = set(_NAME.findall(with_views(text, *views)))
    register_base(spark, sf_dir, [t for t in BASE_TABLES if t in used])
    return spark.sql(with_views(text, *views))


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One fixture view as a DataFrame."""
    return sql(spark, sf_dir, f"select * from {name}", name)
