"""Date dimension, generated from its two bounds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from basketry.contracts import SPINE_BOUNDS
from basketry.functions import dates


def date_spine(
    spark: SparkSession, first: str = SPINE_BOUNDS[0], last: str = SPINE_BOUNDS[1]
) -> DataFrame:
    """One row per day from ``first`` to ``last``, both included."""
    days = F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"), F.expr("interval 1 day"))
    day = F.col("full_date")
    return spark.range(1).select(F.explode(days).alias("full_date")).select(
        F.date_format(day, "yyyyMMdd").alias("date_key"),
        day,
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.date_format(day, "MMM").alias("month_short"),
        F.weekofyear(day).alias("week_of_year"),
        F.dayofmonth(day).alias("day_of_month"),
        F.dayofweek(day).alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.date_format(day, "EEE").alias("day_short"),
        dates.is_weekend(day).alias("is_weekend"),
        (~dates.is_weekend(day)).alias("is_weekday"),
        F.date_format(day, "yyyy-MM").alias("year_month"),
        dates.quarter_label(day).alias("quarter_label"),
    )


def days_in(first: str, last: str) -> int:
    """Number of rows of the spine, known without running anything."""
    from datetime import date

    return (date.fromisoformat(last) - date.fromisoformat(first)).days + 1
