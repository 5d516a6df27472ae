"""Projection (P1-P7), filters (F1-F10) and sort / dedup / set operators
(O1-O5). All are narrow transformations except where a shuffle is stated.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.scalar import _c

# ---------------------------------------------------------------- projection


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename many columns at once."""
    return df.withColumnsRenamed(dict(mapping))


def keep(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Keep list (column pruning reaches the Parquet scan)."""
    return df.select(*cols)


def drop(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop list."""
    return df.drop(*cols)


def reorder(df: DataFrame, first_cols: Sequence[str]) -> DataFrame:
    """Move columns to the front, the rest keep their order."""
    rest = [c for c in df.columns if c not in set(first_cols)]
    return df.select(*first_cols, *rest)


def derive(df: DataFrame, **exprs: Column) -> DataFrame:
    """P5: add / replace computed columns in one projection."""
    return df.withColumns(exprs)


_KINDS = {
    "numeric": (T.NumericType,),
    "integer": (T.IntegerType, T.LongType, T.ShortType, T.ByteType),
    "float": (T.FloatType, T.DoubleType, T.DecimalType),
    "string": (T.StringType,),
    "datetime": (T.DateType, T.TimestampType, T.TimestampNTZType),
    "boolean": (T.BooleanType,),
}


def select_dtypes(df: DataFrame, include: Sequence[str] = ("numeric",),
                  exclude: Sequence[str] = ()) -> DataFrame:
    """Select the columns whose type is of the given kinds (schema walk)."""
    inc = tuple(t for k in include for t in _KINDS[k])
    exc = tuple(t for k in exclude for t in _KINDS[k])
    cols = [f.name for f in df.schema.fields
            if isinstance(f.dataType, inc) and not (exc and isinstance(f.dataType, exc))]
    return df.select(*cols)


def join_select(a: DataFrame, b: DataFrame, on: Sequence[str] | Column,
                how: str = "inner") -> DataFrame:
    """Join where, for a column name present on both sides, the left
    (first-named) table's value is kept; other right columns are appended."""
    la, rb = a.alias("_l"), b.alias("_r")
    if isinstance(on, Column):
        cond = on
        keys: list[str] = []
    else:
        keys = list(on)
        cond = None
        for k in keys:
            e = F.col(f"_l.{k}") == F.col(f"_r.{k}")
            cond = e if cond is None else cond & e
    j = la.join(rb, cond, how)
    left_cols = [F.col(f"_l.{c}").alias(c) for c in a.columns]
    right_cols = [F.col(f"_r.{c}").alias(c) for c in b.columns if c not in set(a.columns)]
    return j.select(*left_cols, *right_cols)


# ------------------------------------------------------------------- filters


def filter_eq(df: DataFrame, c: str, v) -> DataFrame:
    """equality filter (pushed to the scan)."""
    return df.where(F.col(c) == F.lit(v))


def filter_in(df: DataFrame, c: str, vals: Sequence) -> DataFrame:
    """membership."""
    return df.where(F.col(c).isin(list(vals)))


def filter_not_in(df: DataFrame, c: str, vals: Sequence, keep_missing: bool = True) -> DataFrame:
    """negative membership; a missing value is 'not in' the list and kept
    (SAS semantics), unless ``keep_missing`` is False (SQL semantics)."""
    cond = ~F.col(c).isin(list(vals))
    if keep_missing:
        cond = cond | F.col(c).isNull()
    return df.where(cond)


def filter_between(df: DataFrame, lo, c: ColumnOrStr, hi) -> DataFrame:  # noqa: F821
    """chained range ``lo <= c <= hi``."""
    return df.where(_c(c).between(lo, hi))


def dropna_any(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """drop rows missing any column of the subset (NaN counts as missing)."""
    return df.na.drop("any", subset=list(subset) if subset else None)


def drop_at_or_below(df: DataFrame, c: str, v) -> DataFrame:
    """delete rows with c <= v where missing counts as the smallest value,
    so missing rows are deleted too (keep c > v)."""
    return df.where(F.col(c) > F.lit(v))


def delete_if(df: DataFrame, cond: Column) -> DataFrame:
    """delete rows where ``cond`` is true; rows where it is unknown stay."""
    return df.where(~F.coalesce(cond, F.lit(False)))


def drop_last(df: DataFrame, order: Sequence[str], n: int = 1) -> DataFrame:
    """F8: drop the last ``n`` rows in the order of the unique key ``order``.

    The n keys come from a top-n (per-partition top-k then merge; no global
    window), then a left-anti join removes them."""
    from tessera.operators.joins import null_safe_join

    last = df.select(*order).orderBy(*[F.col(c).desc() for c in order]).limit(n)
    return null_safe_join(df, last, list(order), "left_anti")


def slice_from(df: DataFrame, c: str, lo) -> DataFrame:
    """rows whose label is at or after ``lo``."""
    return df.where(F.col(c) >= F.lit(lo))


def count_negative(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """number of negative values per column, one pass, one row."""
    return df.agg(*[F.count_if(F.col(c) < 0).cast("bigint").alias(c) for c in cols])


# ------------------------------------------------------ sort, dedup, append


def sort(df: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    """O1: multi-key sort (range-partitioned sort; use only where the output
    order matters)."""
    return df.orderBy(*keys)


def _order_spec(order: Sequence) -> list[tuple[str, bool]]:
    out = []
    for o in order:
        if isinstance(o, tuple):
            out.append((o[0], bool(o[1])))
        else:
            out.append((o, True))
    return out


def first_per_key(df: DataFrame, key: Sequence[str], order: Sequence) -> DataFrame:
    """O2: one row per key, the first by ``order`` (which must end in a unique
    column so the choice is deterministic).

    ``order`` items are column names (ascending) or ``(name, ascending)``.
    When all directions agree it is one hash aggregation with ``min_by`` /
    ``max_by`` over a struct, which is combined map-side, so a key holding a
    third of the rows costs no more than any other key. Mixed directions use
    the salted two-stage ``top_k_per_group``.
    """
    spec = _order_spec(order)
    key = list(key)
    dirs = {asc for _, asc in spec}
    if len(dirs) == 1:
        payload = F.struct(*[F.col(c) for c in df.columns if c not in key])
        ordkey = F.struct(*[F.col(c) for c, _ in spec])
        pick = F.min_by(payload, ordkey) if dirs.pop() else F.max_by(payload, ordkey)
        return (df.groupBy(*key).agg(pick.alias("_row"))
                .select(*key, "_row.*").select(*df.columns))
    return top_k_per_group(df, key, order, 1).drop("rank")


SALTS = 1024


def top_k_per_group(df: DataFrame, group: Sequence[str], order: Sequence, k: int,
                    rank_col: str = "rank", salts: int = SALTS) -> DataFrame:
    """The first ``k`` rows per group by ``order`` (items are names, ascending,
    or ``(name, ascending)``; end with a unique column for a defined result),
    with their rank 1..k.

    Two windows instead of one: rows are spread over ``salts`` sub-groups by a
    hash of the row, each sub-group keeps its own top k, and the final top k
    per group is taken over at most k x salts survivors. A group holding a
    third of the table is therefore ranked by many tasks, and the result is
    the same as a single window per group."""
    from pyspark.sql import Window

    spec = _order_spec(order)
    group = list(group)
    ords = [F.col(c).asc() if a else F.col(c).desc() for c, a in spec]
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(salts))
    s1 = Window.partitionBy(*group, "_salt").orderBy(*ords)
    part = df.withColumn("_salt", salt).withColumn("_r1", F.row_number().over(s1)).where(F.col("_r1") <= k)
    s2 = Window.partitionBy(*group).orderBy(*ords)
    return (part.withColumn(rank_col, F.row_number().over(s2)).where(F.col(rank_col) <= k)
            .drop("_salt", "_r1"))


def duplicate_count(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """O3: rows minus distinct rows, in one aggregation."""
    cols = list(cols or df.columns)
    g = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))
    return g.agg(F.coalesce(F.sum(F.col("_n")), F.lit(0)).cast("bigint").alias("rows"),
                 F.count(F.lit(1)).cast("bigint").alias("distinct_rows"),
                 F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("bigint").alias("duplicates"))


def dedup(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """O3: remove whole-row duplicates (or duplicates of a column subset,
    keeping one arbitrary row -- use ``first_per_key`` for a defined choice)."""
    return df.distinct() if not cols else df.dropDuplicates(list(cols))


def head(df: DataFrame, n: int, order: Sequence[str | Column]) -> DataFrame:
    """First n rows in a defined order (TakeOrderedAndProject: a per-
    partition top-n, then a merge of n x partitions rows)."""
    return df.orderBy(*order).limit(n)


def append(a: DataFrame, b: DataFrame, rename: Mapping[str, str] | None = None) -> DataFrame:
    """Stack two tables after aligning names; missing columns become NULL."""
    if rename:
        b = b.withColumnsRenamed(dict(rename))
    return a.unionByName(b, allowMissingColumns=True)


ColumnOrStr = Column | str
