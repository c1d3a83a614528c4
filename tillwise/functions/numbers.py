"""Exact money, deterministic rounding and division that yields NULL instead of failing.

Money is DECIMAL, so sums do not depend on the order in which partitions arrive. Ratios are
doubles made from exact sums, rounded half up through DECIMAL(28,8).
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_FINE = "decimal(28,8)"


def _col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def double(x: Column | str) -> Column:
    return _col(x).cast("double")


def rounded(x: Column | str, digits: int) -> Column:
    """Round half up to ``digits`` places, as a double."""
    return F.round(_col(x).cast(_FINE), digits).cast("double")


def ratio(a: Column | str, b: Column | str) -> Column:
    """``a / b`` in doubles; NULL where ``b`` is 0 or missing."""
    return F.try_divide(double(a), double(b))


def percent_of(a: Column | str, b: Column | str, digits: int) -> Column:
    """``a`` as a percentage of ``b``."""
    return rounded(ratio(a, b) * F.lit(100.0), digits)


def growth_pct(new: Column | str, old: Column | str, digits: int = 2) -> Column:
    """Change from ``old`` to ``new`` in percent of ``old``."""
    return percent_of(_col(new) - _col(old), old, digits)


def safe_pct_change(new: Column | str, old: Column | str, digits: int = 2) -> Column:
    """Change in percent of the magnitude of ``old``; NULL where ``old`` is 0 or missing."""
    return percent_of(_col(new) - _col(old), F.abs(_col(old)), digits)


def mean_of_sum(total: Column | str, count: Column | str) -> Column:
    """Mean from an exact sum and a row count."""
    return ratio(total, count)


def rounded_mean(total: Column | str, count: Column | str, digits: int = 2) -> Column:
    """Rounded mean of money over a few rows, divided in decimals so that a half cent is a half."""
    rows = F.nullif(_col(count).cast("decimal(6,0)"), F.lit(0))
    return F.round(_col(total).cast("decimal(30,2)") / rows, digits).cast("double")


def exact_avg(x: Column | str) -> Column:
    """Aggregate: mean whose sum is taken in decimals, hence the same for any row order."""
    return ratio(F.sum(_col(x).cast(_FINE)), F.count(_col(x)))
