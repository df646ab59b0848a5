"""The five KPI tables, each a full recomputation from the fact table.

``one_row_per_order`` states that ``order_id`` is unique in the fact, as it is when the orders were
deduplicated over their whole life. Counting orders then is counting rows: no exact distinct count,
hence no shuffle by order and no second copy of each row. Leave it off for facts built with
deduplication bounded in time, where an order may come back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from basketry import contracts as C
from basketry.functions import dates, measures as M
from basketry.operators import ranking
from basketry.session import ROWS_PER_TASK, staged


def _orders(one_row_per_order: bool) -> Column:
    counted = F.count if one_row_per_order else F.count_distinct
    return counted("order_id").alias("total_orders")


def _customers() -> Column:
    return F.count_distinct("customer_id")


def stamped(kpi: DataFrame) -> DataFrame:
    """Add the time of the refresh; left out of the functions below to keep them repeatable."""
    return kpi.withColumn(C.REFRESHED_AT, F.current_timestamp())


def by_region_category(fact: DataFrame, one_row_per_order: bool = False) -> DataFrame:
    return fact.groupBy("region", "category_of_goods", "order_year").agg(
        M.total("sales").alias("total_sales"),
        M.total("profit").alias("total_profit"),
        M.total("net_sales").alias("total_net_sales"),
        _orders(one_row_per_order),
        F.sum("quantity").alias("total_quantity"),
        M.mean("discount", 4).alias("avg_discount"),
        M.mean("profit_margin_pct", 4).alias("avg_profit_margin"),
        M.ratio_of_sums("profit", "sales", 4).alias("overall_margin"),
    )


def by_customer_segment(fact: DataFrame, one_row_per_order: bool = False) -> DataFrame:
    return fact.groupBy("segment", "city_type", "outlet_type", "order_year").agg(
        _customers().alias("unique_customers"),
        _orders(one_row_per_order),
        M.total("sales").alias("total_sales"),
        M.total("profit").alias("total_profit"),
        M.mean("sales", 2).alias("avg_order_value"),
        M.sum_per("sales", _customers()).alias("avg_revenue_per_customer"),
        F.round(F.avg("shipping_days"), 1).alias("avg_shipping_days"),
        M.mean("discount", 4).alias("avg_discount"),
    )


def product_totals(fact: DataFrame, one_row_per_order: bool = False) -> DataFrame:
    return fact.groupBy("product_id", "sub_category", "category_of_goods").agg(
        _orders(one_row_per_order),
        F.sum("quantity").alias("total_quantity_sold"),
        M.total("sales").alias("total_sales"),
        M.total("profit").alias("total_profit"),
        M.mean("sales", 2).alias("avg_order_sales"),
        M.mean("profit_margin_pct", 4).alias("avg_profit_margin"),
        M.mean("discount", 4).alias("avg_discount"),
        _customers().alias("unique_customers"),
    )


def by_product(
    fact: DataFrame, one_row_per_order: bool = False, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """Product totals ranked by sales within the category.

    The totals are written to the shared folder first (a job of its own): ranking reads them twice,
    and one row per product is far less than a second pass over the fact.
    """
    totals = staged(product_totals(fact, one_row_per_order), "product-totals")
    return ranking.rank_in_group(
        totals, ["category_of_goods"], "total_sales", "sales_rank_in_category", rows_per_task
    )


def top_products(fact: DataFrame, k: int, one_row_per_order: bool = False) -> DataFrame:
    """The ``k`` best-selling products of each category, ties included."""
    return ranking.top_in_group(
        product_totals(fact, one_row_per_order),
        ["category_of_goods"], "total_sales", "sales_rank_in_category", k,
    )


def monthly_totals(fact: DataFrame, one_row_per_order: bool = False) -> DataFrame:
    return fact.groupBy("year_month", "region", "category_of_goods").agg(
        M.total("sales").alias("monthly_sales"),
        M.total("profit").alias("monthly_profit"),
        _orders(one_row_per_order).alias("monthly_orders"),
        F.sum("quantity").alias("monthly_quantity"),
        M.mean("discount", 4).alias("avg_discount"),
    )


def monthly_trend(
    fact: DataFrame, one_row_per_order: bool = False, calendar_months: bool = False
) -> DataFrame:
    """Monthly totals with the month before and the growth since.

    "The month before" is the last month that has sales. With ``calendar_months`` it must be the
    calendar month directly before, else it is NULL. The window holds one row per month of the date
    dimension, whatever the size of the fact.
    """
    in_order = Window.partitionBy("region", "category_of_goods").orderBy("year_month")
    before = F.lag("monthly_sales").over(in_order)
    if calendar_months:
        adjacent = F.lag(dates.month_number("year_month")).over(in_order) + 1
        before = F.when(adjacent == dates.month_number("year_month"), before)
    return (
        monthly_totals(fact, one_row_per_order)
        .withColumn("prev_month_sales", before)
        .withColumn("mom_growth_pct", M.growth_percent("monthly_sales", "prev_month_sales"))
    )


def by_outlet_city(fact: DataFrame, one_row_per_order: bool = False) -> DataFrame:
    return fact.groupBy("outlet_type", "city_type", "region", "order_year").agg(
        _orders(one_row_per_order),
        _customers().alias("unique_customers"),
        M.total("sales").alias("total_sales"),
        M.total("profit").alias("total_profit"),
        M.mean("sales", 2).alias("avg_order_value"),
        M.mean("profit_margin_pct", 4).alias("avg_profit_margin"),
        M.ratio_of_sums("profit", "sales", 2, times=100).alias("profit_pct"),
        F.round(F.avg("shipping_days"), 1).alias("avg_shipping_days"),
        M.share_percent(F.col("ship_mode") == "Same Day").alias("pct_same_day"),
        M.share_percent(F.col("ship_mode") == "Standard Class").alias("pct_standard_class"),
    )


KPI_TABLES = {
    C.KPI_REGION_CATEGORY: by_region_category,
    C.KPI_SEGMENT: by_customer_segment,
    C.KPI_PRODUCT: by_product,
    C.KPI_MONTHLY: monthly_trend,
    C.KPI_OUTLET_CITY: by_outlet_city,
}

# Sort keys of the tables that are presented in order. A stored table has no order of its own, so
# readers apply these.
PRESENTATION_ORDER = {
    C.KPI_REGION_CATEGORY: ["region", "category_of_goods", "order_year"],
    C.KPI_MONTHLY: ["year_month", "region", "category_of_goods"],
}
