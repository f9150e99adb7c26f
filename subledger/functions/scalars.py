"""Scalar column helpers. All are built-in Spark expressions (codegen, no UDF).

The bronze layer is all text, so every model parses with *safe* casts that
return null on bad input instead of failing the job.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from subledger.params import TRUE_TEXT

ColumnOrName = Column | str

ISO_DATE = "yyyy-MM-dd"
# Date layouts written by the reference's data generator besides ISO, in the
# order a month-first reader tries them (see ``multi_format_date``).
OTHER_DATE_LAYOUTS = ("MM/dd/yyyy", "dd/MM/yyyy", "MM-dd-yyyy", "dd-MM-yyyy")


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def iso_date(c: ColumnOrName) -> Column:
    """``try_to_date(c, 'YYYY-MM-DD')``: ISO text to date, null when unparseable."""
    return F.try_to_date(_c(c), ISO_DATE)


def multi_format_date(c: ColumnOrName, layouts=(ISO_DATE, *OTHER_DATE_LAYOUTS)) -> Column:
    """First layout that parses wins; ambiguous day/month text resolves by order."""
    return F.coalesce(*[F.try_to_date(_c(c), fmt) for fmt in layouts])


def whole_number(c: ColumnOrName) -> Column:
    """One-argument ``try_to_number``: scale 0, rounds half away from zero.

    So '0.30' is 0 and '0.5' is 1; text that is not a number is null.
    """
    return _c(c).try_cast("decimal(38,0)")


def money(c: ColumnOrName, precision: int, scale: int = 2) -> Column:
    """``try_to_number(c, p, s)``: rounded to ``scale``, null on overflow."""
    return _c(c).try_cast(f"decimal({precision},{scale})")


def positive_money(c: ColumnOrName, precision: int) -> Column:
    """Money kept only when its whole-number reading is positive, else null."""
    return F.when(whole_number(c) > 0, money(c, precision))


def lower_trim(c: ColumnOrName) -> Column:
    return F.lower(F.trim(_c(c)))


def upper_trim(c: ColumnOrName) -> Column:
    return F.upper(F.trim(_c(c)))


def text_to_bool(c: ColumnOrName) -> Column:
    """True for TRUE/1/YES in any case and padding; everything else (null too) false."""
    return flag(upper_trim(c).isin(*TRUE_TEXT))


def flag(cond: Column) -> Column:
    """``case when cond then true else false end``: a null condition is false."""
    return F.when(cond, F.lit(True)).otherwise(F.lit(False))


def month_start(d: ColumnOrName) -> Column:
    """``date_trunc('month', d)`` that stays a DATE."""
    return F.trunc(_c(d), "MM")


def months_between_boundaries(start: ColumnOrName, end: ColumnOrName) -> Column:
    """``datediff('month', a, b)``: month boundaries crossed, not whole months.

    Jan 31 -> Feb 1 is 1. Spark's own month difference counts whole months.
    """
    s, e = _c(start), _c(end)
    return ((F.year(e) - F.year(s)) * 12 + (F.month(e) - F.month(s))).cast("int")
