"""Exact means and percentages with SQL NUMERIC rounding (half away from zero).

``avg(decimal)`` in Spark already rounds to scale+4 and ``avg(int)`` is a
double, so ``round(avg(x), n)`` can round twice. These helpers divide exact
sums by counts in DECIMAL and round once (Spark's decimal ROUND is HALF_UP,
i.e. away from zero on ties). With ``decimal(20,2) / decimal(20,0)`` the
quotient keeps 20 fractional digits, so a tie can only be missed for more than
10**18 rows.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

SUM_DEC = "decimal(20,2)"
COUNT_DEC = "decimal(20,0)"
HUNDRED = Decimal("100.0")


def exact_mean(value: Column, digits: int) -> Column:
    """``ROUND(AVG(value), digits)`` on the exact quotient (aggregate expression).

    Works for integer and ``decimal(10,2)`` inputs; NULLs are skipped in both
    the sum and the count, as in SQL ``AVG``.
    """
    return F.round(F.sum(value).cast(SUM_DEC) / F.count(value).cast(COUNT_DEC), digits)


def exact_ratio(num: Column, den: Column, digits: int, scale: Decimal = Decimal(1)) -> Column:
    """``ROUND(scale * num / den, digits)`` in exact decimal arithmetic."""
    return F.round(F.lit(scale) * num.cast(COUNT_DEC) / den.cast(COUNT_DEC), digits)


def pct(num: Column, den: Column, digits: int = 1) -> Column:
    """``ROUND(100.0 * num / den, digits)``; NULL when ``den`` is 0."""
    return F.when(den != 0, exact_ratio(num, den, digits, HUNDRED))


def plain_mean(value: Column, scale: int = 0) -> Column:
    """Unrounded mean as a double, computed from an exact integer sum.

    ``avg(double)`` depends on summation order in its last bits. Here the sum
    is taken in exact integer units (``scale`` = decimal places of ``value``)
    and then divided in a fixed sequence of IEEE operations, so every run and
    every engine doing the same steps yields the same double.
    """
    units = value if scale == 0 else (value * (10**scale)).cast("bigint")
    out = F.try_divide(F.sum(units).cast("double"), F.count(value).cast("double"))
    return out / float(10**scale) if scale else out
