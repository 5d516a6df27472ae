"""Reshape R1-R5."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.joins import null_safe_join


def widen(df: DataFrame, keys: Sequence[str], cat: str, values: Sequence, measures: Sequence[str],
          agg: str = "sum", fill=None) -> DataFrame:
    """Long -> wide: one column per (category value, measure), named
    ``{value}_{measure}``. The category values are given, so no extra job is
    run to discover them and the output schema is fixed."""
    fn = getattr(F, agg)
    w = df.groupBy(*keys).pivot(cat, list(values)).agg(*[fn(m).alias(m) for m in measures])
    if len(measures) == 1:
        w = w.withColumnsRenamed({str(v): f"{v}_{measures[0]}" for v in values})
    if fill is not None:
        w = w.na.fill(fill)
    return w


def entities_as_columns(df: DataFrame, row_key: Sequence[str], entity: str, values: Sequence,
                        measure: str) -> DataFrame:
    """R2: result matrix with one column per entity (e.g. site or region)."""
    return df.groupBy(*row_key).pivot(entity, list(values)).agg(F.first(measure))


def lengthen(df: DataFrame, ids: Sequence[str], cols: Sequence[str], var: str = "variable",
             value: str = "value") -> DataFrame:
    """Wide -> long (``unpivot``); a narrow, shuffle-free transformation."""
    return df.unpivot(list(ids), list(cols), var, value)


def _ordinal(df: DataFrame, period: str):
    """The period as a whole number, where its type has one of itself."""
    kind = dict(df.dtypes)[period]
    if kind in ("tinyint", "smallint", "int", "bigint"):
        return F.col(period).cast("bigint")
    return F.unix_date(period).cast("bigint") if kind == "date" else None


def _periods_seen(df: DataFrame, keys: Sequence[str], ordinal) -> DataFrame:
    """(keys, _np): distinct periods of each entity. 64 periods are the bits of
    one long, or-ed together where the rows are, so what is shuffled is a long
    for each entity and stretch of periods, not its periods."""
    word = F.shiftright(ordinal, 6)
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(ordinal, F.lit(64)).cast("int"))
    words = df.groupBy(*keys, word.alias("_word")).agg(F.bit_or(bit).alias("_bits"))   # a missing period has no bit
    return words.groupBy(*keys).agg(F.coalesce(F.sum(F.bit_count("_bits")), F.lit(0)).cast("bigint").alias("_np"))


def complete_entities(df: DataFrame, entity: Sequence[str], period: str,
                      n_periods: int | None = None, measure: str | None = None) -> DataFrame:
    """Keep only entities that have a row in every period (the number of
    periods is all distinct periods of the table unless given). With
    ``measure``, a period counts for an entity only where the measure is
    present (neither NULL nor NaN). Periods that are dates or whole numbers are
    counted as bits (``_periods_seen``), others as distinct values."""
    entity = list(entity)
    have = df
    if measure is not None:
        v = F.col(measure)
        have = df.where(v.isNotNull() & ~F.isnan(v) if dict(df.dtypes)[measure] in ("double", "float") else v.isNotNull())
    ordinal = _ordinal(df, period)
    if ordinal is None:
        need = n_periods if n_periods is not None else df.select(F.count_distinct(F.col(period))).scalar()
        seen = have.groupBy(*entity).agg(F.count_distinct(F.col(period)).alias("_np"))
    else:
        need = n_periods if n_periods is not None else _periods_seen(df, [], ordinal).select("_np").scalar()
        seen = _periods_seen(have, entity, ordinal)
    full = seen.where(F.col("_np") == need).select(*entity)
    return null_safe_join(df, full, entity, "left_semi")


MAX_LEVELS = 1000


def dummies(df: DataFrame, cols: Sequence[str], levels: dict | None = None, drop_base: dict | None = None,
            sep: str = "_", keep_original: bool = False, max_levels: int = MAX_LEVELS) -> DataFrame:
    """One 0/1 column per level (``{col}_{level}``); a missing value gives
    all zeros. Levels are read once per column unless given; at most
    ``max_levels + 1`` distinct values are fetched, and a column with more
    levels raises instead of producing a data-sized schema. ``drop_base``
    removes a base level."""
    levels = dict(levels or {})
    out = df
    for c in cols:
        lv = levels.get(c)
        if lv is None:
            got = df.select(c).where(F.col(c).isNotNull()).distinct().limit(max_levels + 1).collect()
            if len(got) > max_levels:
                raise ValueError(f"{c}: more than {max_levels} levels; pass levels= or encode another way")
            lv = sorted(r[0] for r in got)
        if drop_base and c in drop_base:
            lv = [x for x in lv if x != drop_base[c]]
        out = out.withColumns({f"{c}{sep}{x}": F.when(F.col(c) == F.lit(x), 1).otherwise(0) for x in lv})
        if not keep_original:
            out = out.drop(c)
    return out
