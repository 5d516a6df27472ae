"""Scalar functions C1-C19: Column -> Column, all built-in Spark expressions
(whole-stage codegen, no Python per row). ANSI mode is on, so every
conversion that may fail uses a ``try_`` form and yields NULL instead.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ColLike = Column | str


def _c(c: ColLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def null_double() -> Column:
    return F.lit(None).cast("double")


# C1 -------------------------------------------------------------------------
def parse_date(c: ColLike, fmt: str = "yyyy-MM-dd") -> Column:
    """Text -> date; text that does not parse gives NULL."""
    return F.try_to_timestamp(_c(c), F.lit(fmt)).cast("date")


# C2 -------------------------------------------------------------------------
def to_day(c: ColLike) -> Column:
    """Cut the time of day (timestamp -> date)."""
    return _c(c).cast("date")


# C3 -------------------------------------------------------------------------
def year_of(c: ColLike) -> Column:
    return F.year(_c(c)).cast("int")


def month_of(c: ColLike) -> Column:
    return F.month(_c(c)).cast("int")


# C4 -------------------------------------------------------------------------
def ym_from_text(c: ColLike) -> tuple[Column, Column]:
    """Year and month from ``yyyy-mm...`` text by position; bad text -> NULL."""
    t = _c(c)
    return t.substr(1, 4).try_cast("int"), t.substr(6, 2).try_cast("int")


# C5 -------------------------------------------------------------------------
def make_day(y: ColLike, m: ColLike, day: int = 28) -> Column:
    """Date from year and month with a fixed day (day 28 exists in every month)."""
    return F.make_date(_c(y), _c(m), F.lit(day))


# C6 -------------------------------------------------------------------------
def rebalance_year(y: ColLike, m: ColLike, start: int = 5) -> Column:
    """Portfolio year: months from ``start`` on belong to year y, earlier ones to y-1."""
    return F.when(_c(m) >= start, _c(y)).otherwise(_c(y) - 1).cast("int")


# C7 -------------------------------------------------------------------------
def fmt_day(c: ColLike) -> Column:
    """Date as ``yyyymmdd`` text."""
    return F.date_format(_c(c), "yyyyMMdd")


def yyyymm(y: ColLike, m: ColLike) -> Column:
    return (_c(y) * 100 + _c(m)).cast("int")


def in_yyyymm(y: ColLike, m: ColLike, lo: int, hi: int) -> Column:
    """Inclusive month range given as integers yyyymm."""
    return yyyymm(y, m).between(lo, hi)


# C8 -------------------------------------------------------------------------
def safe_ln(c: ColLike) -> Column:
    """Natural log; zero, negative or missing -> NULL."""
    return F.when(_c(c) > 0, F.ln(_c(c)))


# C9 -------------------------------------------------------------------------
def abs_diff(a: ColLike, b: ColLike) -> Column:
    return F.abs(_c(a) - _c(b))


# C10 ------------------------------------------------------------------------
def clamp0(c: ColLike) -> Column:
    """Negative, NaN and missing -> 0 (NaN is first made NULL, since NaN >= 0
    is true in Spark)."""
    v = F.nanvl(_c(c).cast("double"), null_double())
    return F.when(v >= 0, v).otherwise(F.lit(0.0))


# C11 ------------------------------------------------------------------------
def round_even(c: ColLike, digits: int = 0) -> Column:
    """Round half to even (as Python's round)."""
    return F.bround(_c(c), digits)


# C12 ------------------------------------------------------------------------
def pct(c: ColLike) -> Column:
    return _c(c) * 100


def frac(c: ColLike) -> Column:
    return _c(c) / 100


# C13 ------------------------------------------------------------------------
def recode(c: ColLike, mapping: Mapping[str, Sequence]) -> Column:
    """Code lists -> label; codes in no list -> NULL (no ``otherwise``)."""
    out = None
    for label, codes in mapping.items():
        cond = _c(c).isin(list(codes))
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out


# C14 ------------------------------------------------------------------------
def dummy(cond: Column, missing: int | None = 0) -> Column:
    """0/1 flag. ``missing=0``: an unknown condition gives 0 (the SAS data-step
    rule); ``missing=None``: it stays NULL (R's NA rule)."""
    if missing is None:
        return F.when(cond, F.lit(1)).when(~cond, F.lit(0))
    return F.when(cond, F.lit(1)).otherwise(F.lit(int(missing)))


# C15 ------------------------------------------------------------------------
def band(c: ColLike, edges: Sequence[float]) -> Column:
    """Right-closed bands: c <= e1 -> 1, e1 < c <= e2 -> 2, ..., c > last -> n+1.
    Missing -> NULL."""
    v = F.nanvl(_c(c).cast("double"), null_double())
    out = None
    for i, e in enumerate(edges, start=1):
        out = F.when(v <= e, F.lit(i)) if out is None else out.when(v <= e, F.lit(i))
    return out.when(v.isNotNull(), F.lit(len(edges) + 1))


# C16 ------------------------------------------------------------------------
def zero_if_missing(c: ColLike) -> Column:
    return F.coalesce(_c(c), F.lit(0))


# C17 ------------------------------------------------------------------------
def flow_ratio(inflow: ColLike, outflow: ColLike, base: ColLike) -> Column:
    """abs(in - out) / base with missing flows as 0; base 0 or missing -> NULL."""
    num = F.abs(zero_if_missing(inflow) - zero_if_missing(outflow))
    return F.try_divide(num.cast("double"), _c(base).cast("double"))


# C18 ------------------------------------------------------------------------
def to_number(c: ColLike, type_: str = "bigint") -> Column:
    """Text -> number; bad text -> NULL."""
    return _c(c).try_cast(type_)


# C19 ------------------------------------------------------------------------
def convert_temperature(df: DataFrame, value: str, unit: str, prefix: str = "") -> DataFrame:
    """Convert C <-> F for a whole column of readings.

    Adds ``{prefix}converted`` (double), ``{prefix}to_unit`` and
    ``{prefix}reason`` ('ok', 'bad unit', 'bad value', 'bad value and unit').
    C -> F is (9v + 160) / 5 and F -> C is (5v - 160) / 9.
    """
    v = _c(value).cast("string").try_cast("double")
    u = F.upper(F.trim(_c(unit)))
    good_u = u.isin("C", "F")
    good_v = v.isNotNull()
    conv = F.when(good_v & (u == "C"), (9 * v + 160) / 5).when(good_v & (u == "F"), (5 * v - 160) / 9)
    reason = (F.when(good_v & good_u, "ok").when(good_v, "bad unit")
              .when(good_u, "bad value").otherwise("bad value and unit"))
    return df.withColumns({
        f"{prefix}converted": conv,
        f"{prefix}to_unit": F.when(good_v & good_u, F.when(u == "C", "F").otherwise("C")),
        f"{prefix}reason": reason,
    })
