"""Band (bucket) columns built from the fixed band tables.

Bands are short CASE chains over a typed value (no text comparisons: the
amount is parsed with ``try_cast`` first, see :func:`to_amount`).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed


def to_amount(c: Column | str) -> Column:
    """Text or number -> decimal(18,2); unparsable text becomes NULL."""
    c = F.col(c) if isinstance(c, str) else c
    return c.try_cast("decimal(18,2)")


def debt_band(amount: Column | str, zero_label: bool = False) -> Column:
    """Debt band of a typed amount. NULL falls into the overflow band, as in
    the portfolio reports. ``zero_label`` adds the "no discount" band for 0
    (used for the discounted value)."""
    a = F.col(amount) if isinstance(amount, str) else amount
    expr = None
    if zero_label:
        expr = F.when(a == 0, F.lit(fixed.DISCOUNT_BAND_ZERO))
    for bound, label in fixed.DEBT_BANDS:
        cond = a <= F.lit(bound)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(fixed.DEBT_BAND_OVER))


def day_band(days: Column | str) -> Column:
    """Day-count band 1-4 .. 29-31, else "Fuera de rango" (NULL too)."""
    d = F.col(days) if isinstance(days, str) else days
    expr = None
    for lo, hi, label in fixed.DAY_BANDS:
        cond = (d >= lo) & (d <= hi)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(fixed.DAY_BAND_OUT))


def arrears_band(days: Column | str) -> Column:
    """Days-in-arrears band: the day bands plus -30..0, 32..100 and NULL."""
    d = F.col(days) if isinstance(days, str) else days
    lo, hi, label = fixed.ARREARS_BAND_LOW
    expr = F.when((d <= hi) & (d >= lo), F.lit(label))
    for lo, hi, label in fixed.DAY_BANDS:
        expr = expr.when((d >= lo) & (d <= hi), F.lit(label))
    lo, hi, label = fixed.ARREARS_BAND_HIGH
    expr = expr.when((d >= lo) & (d <= hi), F.lit(label))
    expr = expr.when(d.isNull(), F.lit(fixed.ARREARS_BAND_NULL))
    return expr.otherwise(F.lit(fixed.DAY_BAND_OUT))


def count_flag(n: Column | str, label: str = fixed.APPLIES, other: str = "") -> Column:
    """``label`` when a count is at least 1, else ``other`` (NULL too)."""
    c = F.col(n) if isinstance(n, str) else n
    return F.when(c.try_cast("bigint") >= 1, F.lit(label)).otherwise(F.lit(other))
