"""Dimensions and the fact table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from basketry import contracts as C
from basketry.operators import quality as Q, scd2
from basketry.operators.calendar import date_spine, days_in
from basketry.operators.star import star_join
from basketry.plans import rules as R, silver

CUSTOMER_KEY, PRODUCT_KEY = ["customer_id"], ["product_id"]


def customer_feed(bronze: DataFrame, as_of: str | None = None) -> DataFrame:
    """Change feed of the customer dimension: every valid cleansed row, not only the first per
    customer, as otherwise no change could ever arrive. The time of the file is kept, if known, to
    tell which of two rows of one ingestion is the later."""
    rows = silver.customer_rows(bronze, *scd2.present(bronze, [C.FILE_MODIFIED]))
    return Q.keep(rows, R.customer_rules(as_of))


def product_feed(bronze: DataFrame) -> DataFrame:
    rows = silver.product_rows(bronze, *scd2.present(bronze, [C.FILE_MODIFIED]))
    return Q.keep(rows, R.PRODUCT_RULES)


def dim_customer(feed: DataFrame, sequence_by: str = C.INGESTED_AT, **split) -> DataFrame:
    """Customer history. Feed it ``silver.customers(...)`` for first-seen attributes only."""
    return scd2.versions(feed, CUSTOMER_KEY, sequence_by, C.DIM_CUSTOMER_COLUMNS, **split)


def dim_product(feed: DataFrame, sequence_by: str = C.INGESTED_AT, **split) -> DataFrame:
    return scd2.versions(feed, PRODUCT_KEY, sequence_by, C.DIM_PRODUCT_COLUMNS, **split)


def current_customers(feed: DataFrame, sequence_by: str = C.INGESTED_AT) -> DataFrame:
    """Current customer attributes straight from the feed, without building the history."""
    return scd2.latest_state(feed, CUSTOMER_KEY, sequence_by, C.DIM_CUSTOMER_COLUMNS)


def current_products(feed: DataFrame, sequence_by: str = C.INGESTED_AT) -> DataFrame:
    return scd2.latest_state(feed, PRODUCT_KEY, sequence_by, C.DIM_PRODUCT_COLUMNS)


def fact_sales(
    spark: SparkSession,
    orders: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    spine: tuple[str, str] = C.SPINE_BOUNDS,
) -> DataFrame:
    """Orders joined with current dimension rows; aborts on a row that breaks a fact rule."""
    joined = star_join(orders, customers, products, date_spine(spark, *spine), days_in(*spine))
    return Q.abort_on_violation(joined, R.FACT_RULES)
