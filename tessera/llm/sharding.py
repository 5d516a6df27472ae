"""Shards that all match the mixture: proportional stratified interleaving.

Rows are shuffled by a seeded hash and ranked within their source; a row's
fractional rank is (rank - phase) / rows of its source, where the phase is a
hash of the source (else all sources with one row would meet in the middle).
Sorted by fractional rank, every stretch holds each source in proportion, and
the order is cut into shards whose row counts are at most one apart.

Only (source, hash) pairs are ranked. Ranks are running sums in salted
buckets with offsets from one count per bucket, so a source with a third of
all rows is spread; the rows with their texts move once, in the last join.
DataFrame functions only.

Defined cases: null keys, texts and sources are values like others (a null
source is a source); rows that repeat are all kept and get places of their
own; an empty table gives no rows; columns of the input named ``shard`` or
``slot`` are replaced, all others are passed on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .store import materialise

SEED = 20240607
BUCKET_ROWS = 2_000


def _running(table: DataFrame, keys: list[str], bucket: str, order: list[str], value: str, out: str) -> DataFrame:
    """The sum of ``value`` over all rows before, in the order (bucket, order)
    within ``keys``, by windows over single buckets and one row per bucket."""
    sizes = table.groupBy(*keys, bucket).agg(F.sum(value).alias("_size"))
    earlier = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(*[F.col(k).alias(f"_{k}_of") for k in keys], F.col(bucket).alias("_bucket_of"),
                         F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(*keys, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    ranked = table.withColumn(out, F.coalesce(F.sum(value).over(inside), F.lit(0)))
    on = F.col(bucket) == F.col("_bucket_of")
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_{k}_of"))
    return ranked.join(sizes, on).withColumn(out, F.col(out) + F.col("_before")).select(*table.columns, out)


def interleave(docs: DataFrame, shards: int = 8, source: str = "source", identity: tuple[str, ...] = ("doc_id", "text"),
               seed: int = SEED) -> DataFrame:
    """``docs`` with ``shard`` (0 to shards - 1) and ``slot`` (gapless from 0
    in each shard). The order depends on the rows and the seed alone."""
    key = F.xxhash64(F.lit(seed), *[F.col(c) for c in identity])
    n = docs.count()
    # small buckets spread a hot source; their number stays at the root of the rows
    buckets = max(1, min(-(-n // BUCKET_ROWS), int(n ** 0.5)))
    rows = docs.select(F.col(source).alias("_source"), key.alias("_key")).groupBy("_source", "_key").agg(F.count("*").alias("_copies"))
    rows = materialise(rows.withColumn("_bucket", F.pmod("_key", F.lit(buckets))), "interleave-keys")
    totals = rows.groupBy("_source").agg(F.sum("_copies").alias("_total")).withColumnRenamed("_source", "_source_of_total")
    ranked = _running(rows, ["_source"], "_bucket", ["_key"], "_copies", "_rank")
    ranked = ranked.join(totals, F.col("_source").eqNullSafe(F.col("_source_of_total")))
    phase = F.pmod(F.xxhash64(F.lit(seed), F.lit("phase"), F.col("_source")), F.lit(1 << 20)) / F.lit(float(1 << 20))
    ranked = ranked.withColumn("_fraction", (F.col("_rank") + phase) / F.col("_total"))
    ranked = ranked.withColumn("_stretch", F.floor(F.col("_fraction") * buckets))
    ranked = materialise(ranked.select("_source", "_key", "_copies", "_fraction", "_stretch"), "interleave-ranks")
    placed = _running(ranked, [], "_stretch", ["_fraction", "_source", "_key"], "_copies", "_position")
    # a null-safe join key would not be the window's: one tag for both, and the texts move once
    tag = F.coalesce(F.concat(F.lit("="), F.col("_source").cast("string")), F.lit(""))
    placed = placed.select(F.col("_key").alias("_placed_key"), tag.alias("_placed_tag"), "_position")
    keep = [c for c in docs.columns if c not in ("shard", "slot")]
    full = docs.withColumns({"_source": F.col(source), "_key": key}).withColumn("_tag", tag)
    full = full.join(placed, (F.col("_key") == F.col("_placed_key")) & (F.col("_tag") == F.col("_placed_tag")))
    # rows with one key take its places one after the other
    copy = F.row_number().over(Window.partitionBy("_key", "_tag").orderBy("_position")) - 1
    full = full.withColumn("_position", F.col("_position") + copy)
    full = full.withColumn("_shard", F.expr(f"(_position * {shards}L) div {max(n, 1)}L"))
    first = F.expr(f"(_shard * {max(n, 1)}L + {shards - 1}L) div {shards}L")
    return full.select(*keep, F.col("_shard").cast("int").alias("shard"), (F.col("_position") - first).alias("slot"))
