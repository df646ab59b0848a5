"""Bronze rows to cleansed customers, products and orders, and the orders' quarantine."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from basketry import contracts as C
from basketry.functions import dates, measures, text
from basketry.operators import quality as Q
from basketry.operators.dedup import first_per_key
from basketry.plans import rules as R

AUDIT = [C.INGESTED_AT, C.SOURCE_FILE]


def customer_rows(bronze: DataFrame, *extra: str) -> DataFrame:
    """Cleansed customer attributes of every sale; ``extra`` columns pass through unchanged."""
    return bronze.select(
        *[text.trimmed(n) for n in ("customer_id", "first_name", "last_name")],
        text.joined("first_name", "last_name").alias("full_name"),
        dates.parsed_day("date_of_birth_raw").alias("dob"),
        text.trimmed_upper("segment").alias("segment"),
        *[text.trimmed(n) for n in ("city_type", "region", "outlet_type", "state", "country")],
        *AUDIT,
        *extra,
    )


def product_rows(bronze: DataFrame, *extra: str) -> DataFrame:
    """Cleansed product attributes of every sale; ``extra`` columns pass through unchanged."""
    names = ("product_id", "product_name", "sub_category", "category_of_goods")
    return bronze.select(*[text.trimmed(n) for n in names], *AUDIT, *extra)


def order_rows(bronze: DataFrame, *extra: str) -> DataFrame:
    """Cleansed, typed sales with derived columns; ``extra`` columns pass through unchanged."""
    order_date, ship_date = dates.parsed_day("order_date_raw"), dates.parsed_day("ship_date_raw")
    texts = (
        "segment", "ship_mode", "outlet_type", "city_type", "region", "state", "country",
    )
    goods = ("category_of_goods", "sub_category", "product_name")
    return bronze.select(
        *[text.trimmed(n) for n in ("order_id", "customer_id", "product_id")],
        order_date.alias("order_date"),
        ship_date.alias("ship_date"),
        dates.parsed_day("sales_date_raw").alias("sales_date"),
        F.col("sales").cast("double"),
        F.col("quantity").cast("int"),
        F.col("discount").cast("double"),
        F.col("profit").cast("double"),
        measures.net_amount().alias("net_sales"),
        measures.guarded_ratio("profit", "sales").alias("profit_margin_pct"),
        dates.days_between(order_date, ship_date).alias("shipping_days"),
        *[text.trimmed(n) for n in texts],
        "postal_code",
        *[text.trimmed(n) for n in goods],
        "year",
        C.SOURCE_FILE,
        C.INGESTED_AT,
        *extra,
    )


def with_order_period(orders: DataFrame) -> DataFrame:
    return orders.withColumns(
        {
            "order_year": dates.text_year("order_date"),
            "order_month": dates.text_month("order_date"),
        }
    )


def customers(bronze: DataFrame, as_of: str | None = None) -> DataFrame:
    """One row per customer: the first seen among those that pass the rules."""
    rows = Q.keep(customer_rows(bronze), R.customer_rules(as_of))
    return first_per_key(rows, ["customer_id"], AUDIT)


def products(bronze: DataFrame) -> DataFrame:
    """One row per product: the first seen among those that pass the rules."""
    rows = Q.keep(product_rows(bronze), R.PRODUCT_RULES)
    return first_per_key(rows, ["product_id"], AUDIT)


def orders(
    bronze: DataFrame,
    first_by: tuple[str, ...] = (C.INGESTED_AT, C.SOURCE_FILE),
    extra: tuple[str, ...] = (),
    dedup_first: bool = False,
) -> DataFrame:
    """One row per order.

    Rows are checked before one is chosen, so a bad first row does not cost the order its good ones.
    ``dedup_first`` chooses before checking. ``extra`` are bronze columns that ``first_by`` needs
    and the result does not.
    """
    rows = order_rows(bronze, *extra)
    if dedup_first:
        kept = Q.keep(first_per_key(rows, ["order_id"], first_by), R.ORDER_RULES)
    else:
        kept = first_per_key(Q.keep(rows, R.ORDER_RULES), ["order_id"], first_by)
    return with_order_period(kept.drop(*extra))


QUARANTINE_COLUMNS = [
    "order_id", "customer_id", "product_id", "sales", "quantity", "discount", "profit",
    "order_date_raw", "ship_date_raw", C.SOURCE_FILE, C.INGESTED_AT,
]


def quarantine(bronze: DataFrame, complete: bool = True) -> DataFrame:
    """Bronze rows that never reach the orders table, with the reason.

    ``complete`` covers every drop rule, so kept and quarantined rows add up to the input. Without
    it only the conditions on id, sales, quantity, discount and profit count, and rows dropped for a
    blank id, a bad date or a sale above the ceiling appear nowhere.
    """
    typed = bronze.withColumns(
        {
            "order_date": dates.parsed_day("order_date_raw"),
            "ship_date": dates.parsed_day("ship_date_raw"),
        }
    )
    reasons = R.SILVER_REASONS + (R.SILVER_FURTHER_REASONS if complete else [])
    reason = Q.first_reason(reasons, R.SILVER_OTHER).alias("failure_reason")
    if complete:
        bad = Q.rejected(Q.tagged(typed, R.ORDER_RULES))
        return bad.select(*QUARANTINE_COLUMNS, reason, Q.VIOLATIONS)
    listed = F.lit(False)
    for item in R.SILVER_REASONS:
        listed = listed | F.coalesce(F.expr(item.condition), F.lit(False))
    return typed.filter(listed).select(*QUARANTINE_COLUMNS, reason)
