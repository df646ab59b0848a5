"""Aggregates and ratios over money columns.

Money arrives as ``double``. Adding doubles gives a total that depends on the order in which tasks
finish, and after rounding that shows in the result. The totals here are added as decimals, so they
are the same for every partitioning and every retry, and turned back into ``double`` at the end.
A group with a value that no such decimal holds (NaN, an infinity, 10^18 or more) is added as doubles,
as plain ``sum`` does, so that the value shows instead of vanishing.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# 18 digits before the point and 6 after; the sum of any number of rows fits decimal(34, 6).
EXACT = "decimal(24,6)"


LIMIT = 1e18


def exact_sum(name: str) -> Column:
    value = F.col(name).cast("double")
    fits = (F.abs(value) < LIMIT) & ~F.isnan(value)
    exact = F.sum(F.when(fits, value).cast(EXACT)).cast("double")
    return F.when(F.count_if(~fits) > 0, F.sum(value)).otherwise(exact)


def total(name: str, digits: int = 2) -> Column:
    return F.round(exact_sum(name), digits)


def mean(name: str, digits: int) -> Column:
    """Average of the non-NULL values; NULL if there is none."""
    return F.round(F.try_divide(exact_sum(name), F.count(name)), digits)


def ratio_of_sums(top: str, bottom: str, digits: int, times: int = 1) -> Column:
    ratio = F.try_divide(exact_sum(top), exact_sum(bottom))
    return F.round(ratio * times if times != 1 else ratio, digits)


def sum_per(name: str, units: Column, digits: int = 2) -> Column:
    return F.round(F.try_divide(exact_sum(name), units), digits)


def share_percent(condition: Column, digits: int = 1) -> Column:
    """Rows meeting ``condition`` in percent of all rows; a NULL condition does not count."""
    return F.round(F.count_if(condition) / F.count(F.lit(1)) * 100, digits)


def net_amount(gross: str = "sales", discount: str = "discount") -> Column:
    return F.round(F.col(gross) * (F.lit(1.0) - F.col(discount)), 2)


def guarded_ratio(top: str, bottom: str, digits: int = 4) -> Column:
    """``top / bottom`` where ``bottom`` is positive, else NULL."""
    return F.round(F.when(F.col(bottom) > 0, F.col(top) / F.col(bottom)), digits)


def growth_percent(now: str, before: str, digits: int = 2) -> Column:
    """Change in percent where the earlier value is present and positive, else NULL."""
    change = (F.col(now) - F.col(before)) / F.col(before) * 100
    return F.round(F.when(F.col(before) > 0, change), digits)
