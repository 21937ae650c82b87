"""Exact money handling and rounding.

Money stays DECIMAL. Rounded means and shares are computed from integer minor
units so that ``ROUND(x / n, 2)`` is exactly half away from zero, with no
detour through a binary double and no second rounding step.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType


def money(col: Column | str, scale: int = 2, precision: int = 18) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return c.cast(DecimalType(precision, scale))


_WHOLE = "decimal(38,0)"


def int_div(a: Column, b: Column) -> Column:
    """Floor division of a non-negative integer by a positive one, exactly.

    Works in DECIMAL(38,0): ``a - a mod b`` is a multiple of ``b``, so the
    quotient is an exact integer, and values far beyond 64 bits (money in
    minor units times a percentage factor, at 100 TB) do not overflow.
    """
    a = a.cast(_WHOLE)
    b = b.cast(_WHOLE)
    return ((a - F.pmod(a, b)) / b).cast(_WHOLE)


def half_up_div(num: Column, den: Column) -> Column:
    """Integer ``round(num / den)`` with halves away from zero, as
    DECIMAL(38,0). Null when ``den`` is 0 or null, like AVG over no rows."""
    n = num.cast(_WHOLE)
    d = den.cast(_WHOLE)
    magnitude = int_div(F.abs(n) * 2 + d, d * 2)
    return F.when(d > 0, (F.signum(n).cast(_WHOLE) * magnitude).cast(_WHOLE))


def mean_half_up(total: Column, count: Column, scale: int = 2) -> Column:
    """``ROUND(total / count, scale)`` for a DECIMAL total, exact, as DOUBLE."""
    units = (total * F.lit(10 ** scale)).cast(_WHOLE)
    return half_up_div(units, count).cast("double") / F.lit(float(10 ** scale))


def pct_half_up(part: Column, whole: Column, scale: int = 1, in_scale: int = 0) -> Column:
    """``ROUND(100 * part / whole, scale)``, exact, as DOUBLE.

    ``part`` and ``whole`` are integers, or DECIMALs with ``in_scale``
    fraction digits; both are moved to integer minor units first.
    """
    factor = 10 ** scale
    unit = 10 ** in_scale
    num = (part * F.lit(unit * 100 * factor)).cast(_WHOLE)
    den = (whole * F.lit(unit)).cast(_WHOLE)
    return half_up_div(num, den).cast("double") / F.lit(float(factor))
