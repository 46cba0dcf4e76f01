"""Scalar building blocks.

All helpers return ``Column`` expressions made of Spark built-ins so they stay
inside whole-stage codegen. The NULL behaviour follows the reports' SQL:
a scalar ``max(x, 0)`` is NULL when ``x`` is NULL (unlike ``greatest``).
"""

from __future__ import annotations

import datetime as _dt
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirebook.params import Bounds, as_bound


MONEY_UNITS = 100_000_000  # parts of a unit that exact_sum adds


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clamp0(x) -> Column:
    """``max(x, 0)`` with NULL in, NULL out."""
    x = _col(x)
    return F.when(x > 0, x).when(x <= 0, F.lit(0))


def clamp(x, hi) -> Column:
    """``min(max(x, 0), hi)``; NULL if ``x`` or ``hi`` is NULL."""
    lo = clamp0(x)
    hi = _col(hi)
    return F.when(lo < hi, lo).when(lo >= hi, hi)


def sgn(is_cancelling="is_cancelling") -> Column:
    """+1 for a normal bank row, -1 for a cancelling one (flag NULL = normal)."""
    return F.when(_col(is_cancelling).isNull(), F.lit(1)).otherwise(F.lit(-1))


def safe_div(a, b) -> Column:
    """Exact division, NULL on a zero or NULL divisor."""
    return F.try_divide(_col(a), _col(b))


def ratio(df, num: str, den: str, truncate: bool = False) -> Column:
    """``num / den`` of two columns of ``df``, NULL on a zero divisor.

    ``truncate=True`` reproduces integer division (toward zero) when both
    columns are integral, as SQL engines that type ``/`` by its operands do;
    otherwise, and by default, the division is exact.
    """
    integral = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
    if truncate and isinstance(df.schema[num].dataType, integral) \
            and isinstance(df.schema[den].dataType, integral):
        return F.when(F.col(den) != 0, F.expr(f"`{num}` div `{den}`"))
    return safe_div(num, den)


def exact_sum(x, over=None) -> Column:
    """Sum of a double amount that doesn't depend on the order of the rows.

    Each amount is taken to the nearest 10**-8 and added as whole units and
    hundred-millionths, two longs that add exactly, so every partitioning
    gives the same bits and equal totals compare as equal. Amounts of 2**53
    and more, infinite ones and NaN are added as doubles. NULLs are skipped;
    the sum of none is NULL. ``over``: a window to sum over.
    """
    sums = [F.sum(p) for p in _parts(x)]
    return _from_parts(*([s.over(over) for s in sums] if over is not None else sums))


def _parts(x) -> list[Column]:
    c = _col(x)
    plain, whole = F.abs(c) < float(1 << 53), F.floor(c)
    return [F.when(plain, whole), F.when(plain, F.floor((c - whole) * MONEY_UNITS + 0.5)), F.when(~plain, c)]


def _from_parts(units: Column, parts: Column, others: Column) -> Column:
    whole = units.cast("decimal(20,0)") * F.lit(MONEY_UNITS).cast("decimal(10,0)") + parts.cast("decimal(20,0)")
    known = (whole.cast("decimal(28,0)") * F.lit(Decimal(1) / MONEY_UNITS)).cast("double")
    return F.when(units.isNull(), others).otherwise(known + F.coalesce(others, F.lit(0.0)))


PARTIAL = ("units", "parts", "others")  # what a stored part of an exact sum holds


def partial_sum(x) -> Column:
    """The part of an ``exact_sum`` that can be stored and added to others: a
    struct of its three sums. ``merged_sum`` of any split of the rows into
    parts has the bits of ``exact_sum`` over all of them."""
    return F.struct(*[F.sum(p).alias(n) for n, p in zip(PARTIAL, _parts(x))])


def merged_sum(x) -> Column:
    """``exact_sum`` over the rows behind stored ``partial_sum`` structs."""
    return _from_parts(*[F.sum(_col(x)[n]) for n in PARTIAL])


def total(df, name: str) -> Column:
    """``exact_sum`` of a column of ``df``; integers and decimals add exactly as they are."""
    double = isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType))
    return exact_sum(name) if double else F.sum(name)


def money(x, digits: int = 2) -> Column:
    """Round a reported amount; ``+ 0.0`` turns a negative zero positive."""
    return F.round(_col(x).cast("double"), digits) + F.lit(0.0)


def date_lit(d) -> Column:
    return F.lit(as_bound(d))


def days_since(df, date_col: str, day) -> Column:
    """Days from ``date_col`` to ``day``: whole ones between dates; with the
    fraction of a day where the column or the bound has a time of day."""
    if isinstance(df.schema[date_col].dataType, T.DateType) and not isinstance(as_bound(day), _dt.datetime):
        return F.datediff(date_lit(day), F.col(date_col))
    micros = [F.unix_micros(x.cast("timestamp")) for x in (date_lit(day), F.col(date_col))]
    return (micros[0] - micros[1]) / F.lit(86_400_000_000.0)


def in_period(date_col, lo, hi, bounds: Bounds = Bounds.HALF_OPEN) -> Column:
    """Row predicate of a period; compares the typed column so it pushes down."""
    d = _col(date_col)
    lo_c, hi_c = date_lit(lo), date_lit(hi)
    if bounds is Bounds.OPEN:
        return (d > lo_c) & (d < hi_c)
    return (d > lo_c) & (d <= hi_c)
