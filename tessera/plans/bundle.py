"""Product-box jobs D24-D28: segment profit matrix, plan evaluation, plan
checks, candidate-box scoring and the plan report.

Tables: cost(product, segment, n, cost) -- n subscribers of the segment and
the unit cost of the product for it; x(product, box); y(segment, box).
The solver of the original study is not rebuilt: a plan is data, and these
jobs evaluate, check and rank plans as Spark joins and aggregations.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.frame import top_k_per_group

PRICE = 8            # fixed value: unit price of every product
BOX_MIN, BOX_MAX = 4, 7   # fixed values: products per box
PRODUCT_CAP = 80000  # fixed value: units of one product over all segments


def profit_matrix(cost: DataFrame, price: float = PRICE) -> DataFrame:
    """profit(i, k) = N(k) * (price - c(i, k))."""
    return cost.select("product", "segment", "n", "cost",
                       (F.col("n") * (F.lit(price) - F.col("cost"))).alias("profit"))


def _assign(x: DataFrame, y: DataFrame) -> DataFrame:
    """(product, box, segment) triples the plan ships: x joined y on the box."""
    return x.select("product", "box").join(y.select("segment", "box"), "box")


def evaluate_plan(x: DataFrame, y: DataFrame, profit: DataFrame, price: float = PRICE) -> DataFrame:
    """Revenue, cost and profit of a plan (one row)."""
    j = _assign(x, y).join(profit, ["product", "segment"])
    return j.agg(F.sum(F.col("n") * F.lit(price)).cast("double").alias("revenue"),
                 F.sum(F.col("n") * F.col("cost")).cast("double").alias("cost"),
                 F.sum("profit").cast("double").alias("profit"),
                 F.count(F.lit(1)).cast("bigint").alias("n_pairs"))


def check_plan(x: DataFrame, y: DataFrame, segments: DataFrame, box_min: int = BOX_MIN,
               box_max: int = BOX_MAX, cap: int = PRODUCT_CAP) -> DataFrame:
    """Every constraint of a plan as a row (rule, key, value, ok):
    products per box within [box_min, box_max]; exactly one box per segment;
    subscribers reached by each product at most ``cap``.
    ``segments``: (segment, n)."""
    size = x.groupBy("box").agg(F.count(F.lit(1)).cast("bigint").alias("value")).select(
        F.lit("box_size").alias("rule"), F.col("box").cast("string").alias("key"), "value",
        F.col("value").between(box_min, box_max).alias("ok"))
    per_seg = (segments.select("segment").join(y.groupBy("segment").agg(F.count(F.lit(1)).alias("_b")), "segment", "left")
               .select(F.lit("segment_boxes").alias("rule"), F.col("segment").alias("key"),
                       F.coalesce("_b", F.lit(0)).cast("bigint").alias("value")))
    per_seg = per_seg.withColumn("ok", F.col("value") == 1)
    reach = (_assign(x, y).join(segments.select("segment", "n"), "segment")
             .groupBy("product").agg(F.sum("n").cast("bigint").alias("value"))
             .select(F.lit("product_cap").alias("rule"), F.col("product").cast("string").alias("key"), "value",
                     (F.col("value") <= cap).alias("ok")))
    return size.unionByName(per_seg).unionByName(reach)


def score_bundles(candidates: DataFrame, profit: DataFrame, k: int = 3) -> DataFrame:
    """Profit of each candidate box for each segment, and the k best
    boxes per segment (ties by box id). ``candidates``: (bundle, product).
    This ranks boxes per segment; it does not claim the joint optimum under
    the product cap (checked by ``check_plan``)."""
    s = (candidates.join(profit.select("product", "segment", "profit"), "product")
         .groupBy("bundle", "segment").agg(F.sum("profit").alias("profit"),
                                           F.count(F.lit(1)).cast("bigint").alias("n_products")))
    # top k per segment in two salted stages (a segment may hold most candidates)
    return top_k_per_group(s, ["segment"], [("profit", False), ("bundle", True)], k)


def plan_report(x: DataFrame, y: DataFrame, names: DataFrame | None = None) -> DataFrame:
    """Per box, its products and its segments as sorted lists joined
    into text (bounded: a box holds at most ``BOX_MAX`` products)."""
    xp = x if names is None else x.join(names, "product", "left")
    label = F.col("product_name") if names is not None else F.col("product").cast("string")
    items = xp.groupBy("box").agg(F.array_join(F.sort_array(F.collect_list(label)), ", ").alias("products"),
                                  F.count(F.lit(1)).cast("bigint").alias("n_products"))
    segs = y.groupBy("box").agg(F.array_join(F.sort_array(F.collect_list("segment")), ", ").alias("segments"))
    return items.join(segs, "box", "full_outer")
