"""Exact decimal arithmetic: half-up rounding of sums, means and ratios.

Spark's ``avg`` of an INT column is a DOUBLE and the ``avg`` of a DECIMAL is
rounded to scale + 4 before any later ``round``. Both would differ from the
exact NUMERIC arithmetic of the warehouse SQL. The helpers below divide exact
decimal sums by counts (Spark keeps up to 38 digits, >= 18 of them after the
point here) and round half-up once.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _c


def money(c, precision: int = 28, scale: int = 2) -> Column:
    """``ROUND(c, scale)`` half-up, then a DECIMAL wide enough for sums at any scale (26 digits before the point)."""
    return F.round(_c(c), scale).cast(f"decimal({precision},{scale})")


def ratio(num: Column, den: Column, scale: int = 2, precision: int = 12) -> Column:
    """``ROUND(num / den, scale)`` half-up; NULL when ``den`` is 0 or NULL (no ANSI error)."""
    return F.round(F.try_divide(num, den), scale).cast(f"decimal({precision},{scale})")


def mean(c, scale: int = 2, precision: int = 12, integral: bool = False) -> Column:
    """Exact ``ROUND(AVG(c), scale)``: decimal sum / non-null count, rounded half-up once.

    ``integral=True`` for INT columns, whose sum is first made a DECIMAL(20,0)
    so that the division stays exact instead of becoming a DOUBLE.
    """
    c = _c(c)
    s = F.sum(c.cast("decimal(20,0)")) if integral else F.sum(c)
    return ratio(s, F.count(c), scale, precision)


def percentage(part: Column, whole: Column, scale: int = 2, precision: int = 5) -> Column:
    """``ROUND(part * 100.0 / whole, scale)`` with exact decimals."""
    return ratio(part.cast("decimal(20,0)") * F.lit(100), whole.cast("decimal(20,0)"), scale, precision)


safe_ratio = ratio  # B21: NULL when the denominator is 0
