"""Price-elasticity jobs D22-D23 (own- and cross-price elasticity from
log-log regressions with promotion and year dummies)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.scalar import dummy, safe_ln
from tessera.operators.stats import corr_test, ols_many, ols_multi_by
from tessera.session import cut_lineage

MEASURES = ["price", "units", "sale"]


def brand_panel(long: DataFrame, labels: Mapping[str, str], keys: Sequence[str] = ("y", "m")) -> DataFrame:
    """One row per period with price / units / sale per brand, named
    ``price_{label}`` etc. (the wide layout of a weekly scanner file).
    ``long``: (brand, *keys, price, units, sale)."""
    w = (long.groupBy(*keys).pivot("brand", list(labels))
         .agg(F.first("price").alias("price"), F.first("units").alias("units"), F.first("sale").alias("sale")))
    ren = {}
    for b, lab in labels.items():
        for m in ("price", "units", "sale"):
            ren[f"{b}_{m}"] = f"{m}_{lab}"
    return w.withColumnsRenamed(ren)


def add_model_terms(wide: DataFrame, labels: Sequence[str], year_col: str = "y",
                    years: Sequence[int] = ()) -> DataFrame:
    """Log price / units (non-positive -> NULL), major (sale 1) and minor
    (sale 2) promotion dummies per brand (NA kept, as R's ifelse), year dummies."""
    cols = {}
    for lab in labels:
        cols[f"ln_p_{lab}"] = safe_ln(f"price_{lab}")
        cols[f"ln_q_{lab}"] = safe_ln(f"units_{lab}")
        cols[f"prom_{lab}_maj"] = dummy(F.col(f"sale_{lab}") == 1, None)
        cols[f"prom_{lab}_min"] = dummy(F.col(f"sale_{lab}") == 2, None)
    for yv in years:
        cols[f"year_{yv}"] = dummy(F.col(year_col) == yv, None)
    return wide.withColumns(cols)


def elasticity(wide: DataFrame, own: str, rivals: Sequence[str], years: Sequence[int] | None = None,
               year_col: str = "y") -> dict[str, DataFrame]:
    """The four nested models, each as an ``OlsResult``-like pair.

    m1: units ~ price; m2: ln q ~ ln p; m3: + own major / minor promotion;
    m4: + year dummies, rivals' ln price and ln units, rivals' promotions.
    The own-price elasticity is the coefficient of ``ln_p_{own}``. Returns
    ``{"coefficients": long table with a model column, "summary": one row per model}``.
    ``years=None`` uses every calendar year present (read from the cached model
    frame, one value per year); with an intercept the last one is aliased, as
    R reports it.
    """
    wide = wide.persist()                  # read by the year list and by the four models
    if years is None:
        years = sorted(r[0] for r in wide.select(year_col).distinct().collect())
    d = add_model_terms(wide, [own, *rivals], year_col, years)
    specs = _models(own, rivals, years)
    coefs, sums = None, None
    fits = ols_many(d, specs)          # all four models from one pass over the data
    for name in specs:
        res = fits[name]
        c = res.coefficients.withColumn("model", F.lit(name))
        s = res.summary.withColumn("model", F.lit(name))
        coefs = c if coefs is None else coefs.unionByName(c)
        sums = s if sums is None else sums.unionByName(s, allowMissingColumns=True)
    wide.unpersist()   # the results are small tables built from the fitted values
    return {"coefficients": coefs, "summary": sums}


def _models(own: str, rivals: Sequence[str], years: Sequence[int]) -> dict[str, tuple[str, list[str]]]:
    """Dependent variable and terms of the four models."""
    return {
        "m1": (f"units_{own}", [f"price_{own}"]),
        "m2": (f"ln_q_{own}", [f"ln_p_{own}"]),
        "m3": (f"ln_q_{own}", [f"ln_p_{own}", f"prom_{own}_maj", f"prom_{own}_min"]),
        "m4": (f"ln_q_{own}", [f"ln_p_{own}", f"prom_{own}_maj", f"prom_{own}_min"]
               + [f"year_{y}" for y in years]
               + [c for r in rivals for c in (f"ln_p_{r}", f"ln_q_{r}")]
               + [c for r in rivals for c in (f"prom_{r}_maj", f"prom_{r}_min")]),
    }


def rival_panel(monthly: DataFrame, brand: str = "brand", keys: Sequence[str] = ("y", "m"), rivals: int = 2) -> DataFrame:
    """Every brand as the own one, beside the next ``rivals`` brands in
    alphabetical order (the last is followed by the first): columns
    ``price_own``, ``units_own``, ``sale_own``, ``price_r2``, ... per brand and month."""
    names = monthly.select(brand).where(F.col(brand).isNotNull()).distinct()
    # one row per brand
    numbered = names.select(brand, F.row_number().over(Window.orderBy(brand)).alias("_i"), F.count(F.lit(1)).over(Window.partitionBy()).alias("_n"))
    m = monthly.join(numbered, brand)
    out = m.select(brand, *keys, "_i", "_n", *[F.col(c).alias(f"{c}_own") for c in MEASURES])
    for r in range(1, rivals + 1):
        label = f"r{r + 1}"
        other = m.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("_i").alias("_j"), *[F.col(c).alias(f"{c}_{label}") for c in MEASURES])
        on = F.col("_j") == F.pmod(F.col("_i") - 1 + r, F.col("_n")) + 1
        for k in keys:
            on = on & (F.col(k) == F.col(f"_{k}"))
        out = out.join(other, on, "left").drop("_j", *[f"_{k}" for k in keys])
    return out.drop("_i", "_n")


def elasticity_by_brand(monthly: DataFrame, brand: str = "brand", year_col: str = "y") -> DataFrame:
    """D22 for every brand: the four nested models of ``elasticity``, each one
    grouped regression over all brands (moments by one aggregation, one
    small system per brand). Brand, model, term, estimate and its statistics, r2, n."""
    years = sorted(r[0] for r in monthly.select(year_col).distinct().collect())   # calendar years
    # read by four models: one reliable checkpoint of the (small) panel
    d = cut_lineage(add_model_terms(rival_panel(monthly, brand), ["own", "r2", "r3"], year_col, years))
    out = None
    for name, (y, xs) in _models("own", ["r2", "r3"], years).items():
        fit = ols_multi_by(d, [brand], y, xs).withColumn("model", F.lit(name))
        out = fit if out is None else out.unionByName(fit)
    return out


def brand_series(monthly: DataFrame, brand: str = "brand", keys: Sequence[str] = ("y", "m")) -> DataFrame:
    """D23 for every brand: price and quantity series with their logs."""
    return monthly.select(brand, *keys, "price", "units", safe_ln("price").alias("ln_price"), safe_ln("units").alias("ln_units"))


def price_quantity_series(wide: DataFrame, own: str, keys: Sequence[str] = ("y", "m")) -> DataFrame:
    """The own brand's price and quantity series (data behind the
    two-axis plot and the pairs plots), with their logs."""
    return wide.select(*keys, F.col(f"price_{own}").alias("price"), F.col(f"units_{own}").alias("units"),
                       safe_ln(f"price_{own}").alias("ln_price"), safe_ln(f"units_{own}").alias("ln_units"))


def price_quantity_tests(series: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Correlation tests of price with quantity, in levels and in logs."""
    lv = corr_test(series, "price", "units", keys).withColumn("scale", F.lit("level"))
    lg = corr_test(series, "ln_price", "ln_units", keys).withColumn("scale", F.lit("log"))
    return lv.unionByName(lg)
