"""Fuel-station jobs D1-D6: daily consumption from tank level readings and
purchases, site mix, monthly joint panel, consumption-cost correlation,
seasonal purchase profile and purchase-volume band mix.

Inputs (column names of the fixture views; rename with ``frame.rename``):
  readings(tank_id, ts, fuel_level), tanks(tank_id, location, tank_type),
  purchases(invoice_id, invoice_date, location, fuel_type, amount, cost),
  sites(location, site_name).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.scalar import clamp0, to_day

GAS_TYPES = ("U", "P")      # fixed values: tank types that hold gas
DIESEL_TYPES = ("D",)       # fixed values: tank types that hold diesel
BAND_EDGES = (15000, 25000, 40000)  # fixed values: right-closed volume bands


def daily_consumption(readings: DataFrame, tanks: DataFrame, purchases: DataFrame,
                      sites: DataFrame, by: str = "calendar", position: str = "ts",
                      how: str = "left") -> DataFrame:
    """Consumption per (day, site) for gas and diesel.

    unit delta = first level - last level of the tank that day (by timestamp);
    fuel consumption = sum of unit deltas at the site; total = consumption +
    purchased (0 if none); negative or missing totals -> 0; every reading day
    kept (a day without site rows gives one row with NULL site); site name
    attached. ``how="left"`` keeps the site-days that have gas readings (the
    gas side left-joins diesel, as written); ``how="outer"`` also keeps
    site-days with diesel readings only.

    Plan: one aggregation of the raw readings to (day, tank) with
    ``min_by/max_by`` (map-side combined, no sort of a tank's readings); the
    calendar and the tank attributes are taken from / joined to that reduced
    table, never to raw readings; one aggregation to (day, site) with both
    fuels as conditional sums (instead of two group-bys and a join); purchases
    reduced to (day, site) the same way; one join on (day, site). The
    calendar has one row per day and is broadcast.
    """
    lv = readings.where(F.col("fuel_level").isNotNull()).withColumn("day", to_day("ts"))
    # one pass over the readings: first-minus-last per (day, tank), map-side
    # combined; the calendar and the tank attributes come after this reduction
    per_tank = lv.groupBy("day", "tank_id").agg(
        (F.min_by("fuel_level", "ts") - F.max_by("fuel_level", "ts")).alias("delta"),
        F.min(position).alias("_first"))
    # calendar: one row per reading day (bounded by the calendar span) -> broadcast
    cal = reading_calendar(per_tank.withColumnRenamed("_first", position), by=by, position=position)

    attrs = tanks.select("tank_id", "location", "tank_type").distinct()
    unit = (per_tank.join(attrs, "tank_id", "left")
            .where(F.col("location").isNotNull())
            .select("day", "tank_id", "location", "tank_type", "delta"))
    is_gas = F.col("tank_type").isin(*GAS_TYPES)
    is_dsl = F.col("tank_type").isin(*DIESEL_TYPES)
    site = (unit.groupBy("day", "location")
            .agg(F.sum(F.when(is_gas, F.col("delta"))).alias("gas_consumption"),
                 F.sum(F.when(is_dsl, F.col("delta"))).alias("diesel_consumption"),
                 F.count_if(is_gas).alias("_n_gas"), F.count_if(is_dsl).alias("_n_dsl")))

    # purchases on reading days only (semi join with the broadcast calendar)
    p = (purchases.withColumnRenamed("invoice_date", "day")
         .join(cal.select("day"), "day", "left_semi")
         .where(F.col("location").isNotNull())
         .groupBy("day", "location")
         .agg(F.sum(F.when(F.col("fuel_type") == "G", F.col("amount"))).alias("gas_purchased"),
              F.sum(F.when(F.col("fuel_type") == "D", F.col("amount"))).alias("diesel_purchased")))

    keep = (F.col("_n_gas") > 0) if how == "left" else ((F.col("_n_gas") > 0) | (F.col("_n_dsl") > 0))
    j = (site.where(keep)
         .join(p, ["day", "location"], "left")
         .select("day", "location", F.when(F.col("_n_gas") > 0, F.col("gas_consumption")).alias("gas_consumption"),
                 F.when(F.col("_n_gas") > 0, F.coalesce("gas_purchased", F.lit(0.0))).alias("gas_purchased"),
                 F.when(F.col("_n_dsl") > 0, F.col("diesel_consumption")).alias("diesel_consumption"),
                 F.when(F.col("_n_dsl") > 0, F.coalesce("diesel_purchased", F.lit(0.0))).alias("diesel_purchased")))
    j = j.withColumns({
        "gas_total": clamp0(F.col("gas_consumption") + F.col("gas_purchased")),
        "diesel_total": clamp0(F.col("diesel_consumption") + F.col("diesel_purchased")),
    })
    # outer join with the calendar without shuffling j on the day key (only
    # calendar-many keys): inner broadcast join, plus the days with no site row
    with_days = j.join(cal, "day", "inner")
    empty_days = cal.join(j.select("day").distinct(), "day", "left_anti")
    full = with_days.unionByName(empty_days, allowMissingColumns=True)
    return (full.join(sites, "location", "left")
            .select("date_number", "day", "location", "site_name", "gas_consumption", "gas_purchased",
                    "gas_total", "diesel_consumption", "diesel_purchased", "diesel_total"))


def reading_calendar(levels: DataFrame, by: str = "calendar", position: str = "ts") -> DataFrame:
    """Day numbers 1, 2, ... of the reading days (``by="calendar"``: in date
    order; ``by="appearance"``: in order of each day's first ``position``,
    e.g. a file row number, as numbering days by first appearance does)."""
    if by == "calendar":
        days = levels.select("day").distinct()
        return days.select("day", F.dense_rank().over(Window.orderBy("day")).cast("int").alias("date_number"))
    days = levels.groupBy("day").agg(F.min(position).alias("_first"))
    return days.select("day", F.row_number().over(Window.orderBy("_first", "day")).cast("int").alias("date_number"))


def site_mix(daily: DataFrame) -> DataFrame:
    """Totals per site and the share of gas and diesel."""
    t = (daily.where(F.col("location").isNotNull() & F.col("site_name").isNotNull())
         .groupBy("location", "site_name")
         .agg(F.coalesce(F.sum("gas_total"), F.lit(0.0)).alias("gas_total"),
              F.coalesce(F.sum("diesel_total"), F.lit(0.0)).alias("diesel_total")))
    t = t.withColumn("total", F.col("gas_total") + F.col("diesel_total"))
    return t.withColumns({"gas_share": F.try_divide(F.col("gas_total"), F.col("total")),
                          "diesel_share": F.try_divide(F.col("diesel_total"), F.col("total"))})


def site_daily_average(daily: DataFrame) -> DataFrame:
    """A8 in D2: total per site divided by the number of days in the whole
    table (the largest day number), rounded half to even."""
    n_days = daily.select(F.max("date_number")).scalar()
    return (daily.where(F.col("location").isNotNull()).groupBy("location")
            .agg(F.bround(F.coalesce(F.sum("gas_total"), F.lit(0.0)) / n_days, 0).alias("avg_gas"),
                 F.bround(F.coalesce(F.sum("diesel_total"), F.lit(0.0)) / n_days, 0).alias("avg_diesel")))


def monthly_joint(daily: DataFrame, purchases: DataFrame) -> DataFrame:
    """D3: (site, month, year) panel of consumption with purchase cost and
    amount for each fuel, zero-filled."""
    cons = (daily.where(F.col("location").isNotNull())
            .withColumns({"month": F.month("day").cast("int"), "year": F.year("day").cast("int")})
            .groupBy("location", "month", "year")
            .agg(F.coalesce(F.sum("gas_total"), F.lit(0.0)).alias("gas_total"),
                 F.coalesce(F.sum("diesel_total"), F.lit(0.0)).alias("diesel_total")))
    pur = (purchases.where(F.col("location").isNotNull())
           .withColumns({"month": F.month("invoice_date").cast("int"), "year": F.year("invoice_date").cast("int")})
           .groupBy("location", "month", "year")
           .pivot("fuel_type", ["G", "D"])
           .agg(F.sum("cost").alias("cost"), F.sum("amount").alias("amount"))
           .withColumnsRenamed({"G_cost": "gas_cost", "G_amount": "gas_amount",
                                "D_cost": "diesel_cost", "D_amount": "diesel_amount"}))
    fill = ["gas_cost", "gas_amount", "diesel_cost", "diesel_amount"]
    return cons.join(pur, ["location", "month", "year"], "left").na.fill(0.0, subset=fill)


def site_corr(joint: DataFrame) -> DataFrame:
    """Per site, correlation of monthly consumption with monthly purchase
    cost, for gas and diesel (long: location, fuel, r)."""
    def r(x, y):
        return F.try_divide(F.covar_samp(x, y), F.stddev_samp(x) * F.stddev_samp(y))
    g = joint.groupBy("location").agg(r(F.col("gas_total"), F.col("gas_cost")).alias("Gas"),
                                      r(F.col("diesel_total"), F.col("diesel_cost")).alias("Diesel"))
    return g.unpivot(["location"], ["Gas", "Diesel"], "fuel", "r")


def seasonal_profile(purchases: DataFrame, year: int | None = None) -> DataFrame:
    """Purchase amount per (month, fuel, site) summed over all years, or
    for one year. One aggregation replaces the per-site, per-year loops."""
    p = purchases.where(F.col("location").isNotNull() & F.col("invoice_date").isNotNull())
    if year is not None:
        p = p.where(F.year("invoice_date") == year)
    return (p.withColumn("month", F.month("invoice_date").cast("int"))
            .where(F.col("month") >= 1)
            .groupBy("month", "fuel_type", "location")
            .agg(F.coalesce(F.sum("amount"), F.lit(0.0)).alias("amount")))


def discount_mix(purchases: DataFrame, edges: Sequence[float] = BAND_EDGES,
                 fuels: Sequence[str] = ("D", "G")) -> DataFrame:
    """Percent of purchases of each fuel at each site falling into each
    right-closed volume band; all bands shown (0 if empty), NULL when the site
    has no purchases of that fuel. Percent = 100 * rows(site, fuel, band) /
    rows(site, fuel)."""
    from tessera.functions.scalar import band

    p = purchases.where(F.col("location").isNotNull()).withColumn("band", band("amount", edges))
    counts = p.groupBy("location", "fuel_type", "band").agg(F.count(F.lit(1)).alias("_n"))
    tot = p.groupBy("location", "fuel_type").agg(F.count(F.lit(1)).alias("_tot"))
    grid = (p.select("location").distinct()
            .select("location", F.explode(F.array(*[F.lit(f) for f in fuels])).alias("fuel_type"))
            .select("location", "fuel_type",
                    F.explode(F.array(*[F.lit(i) for i in range(1, len(edges) + 2)])).alias("band")))
    j = grid.join(tot, ["location", "fuel_type"], "left").join(counts, ["location", "fuel_type", "band"], "left")
    return j.select("location", "fuel_type", "band",
                    (F.coalesce(F.col("_n"), F.lit(0)) * 100.0 / F.col("_tot")).alias("percent"))
