from __future__ import annotations

from pyspark.sql import Column, functions as F

_DAY_SHAPE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
SUNDAY, SATURDAY = 1, 7


def parsed_day(text: Column | str) -> Column:
    """Strict ``yyyy-MM-dd``; anything else is NULL, never an error, whatever the ANSI setting.

    A cast alone would also take ``2020-1-5``, hence the test of the shape. Parsing by pattern is
    as strict, but raises and catches an exception for every bad value, which is many times slower.
    """
    column = F.col(text) if isinstance(text, str) else text
    return F.when(column.rlike(_DAY_SHAPE), column.try_cast("date"))


def days_between(first: Column | str, last: Column | str) -> Column:
    """Whole days from ``first`` to ``last``; negative if ``last`` is earlier."""
    return F.date_diff(last, first)


def is_weekend(day: Column | str) -> Column:
    return F.dayofweek(day).isin(SUNDAY, SATURDAY)


def quarter_label(day: Column | str) -> Column:
    return F.concat(F.lit("Q"), F.quarter(day), F.lit("-"), F.year(day))


def text_year(day: Column | str) -> Column:
    return F.year(day).cast("string")


def text_month(day: Column | str) -> Column:
    return F.month(day).cast("string")


def month_number(year_month: Column | str) -> Column:
    """Running month index of a ``yyyy-MM`` text, for comparisons across year ends."""
    column = F.col(year_month) if isinstance(year_month, str) else year_month
    return F.substring(column, 1, 4).cast("int") * 12 + F.substring(column, 6, 2).cast("int")
