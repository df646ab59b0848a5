"""Bronze changes to the silver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from basketry import contracts as C
from basketry.operators import dedup, quality as Q
from basketry.plans import rules as R, silver

GLOBAL, WITHIN = "global", "within"


def customer_rows(bronze: DataFrame, as_of: str | None = None) -> DataFrame:
    """Valid customer rows; violations of all rules are counted in the progress of the query."""
    rules = R.customer_rules(as_of)
    return Q.keep(Q.watched(silver.customer_rows(bronze), rules, C.SILVER_CUSTOMERS), rules)


def product_rows(bronze: DataFrame) -> DataFrame:
    rows = Q.watched(silver.product_rows(bronze), R.PRODUCT_RULES, C.SILVER_PRODUCTS)
    return Q.keep(rows, R.PRODUCT_RULES)


def order_rows(bronze: DataFrame) -> DataFrame:
    """Valid order rows, not deduplicated."""
    rows = silver.order_rows(bronze)
    return Q.keep(Q.watched(rows, R.ORDER_RULES, C.SILVER_ORDERS), R.ORDER_RULES)


def orders(
    bronze: DataFrame, mode: str = GLOBAL, horizon: str = C.LATE_HORIZON, salts: int = 1
) -> DataFrame:
    """First valid row seen per order.

    ``global`` remembers every order; rows older than the watermark are dropped, and state is never
    released. ``within`` forgets an order after ``horizon``, so state is bounded and an order that
    returns later than that is let through again. ``salts`` above 1 spreads an order that holds
    much of a trigger over that many tasks first.
    """
    rows = order_rows(bronze)
    if mode == GLOBAL:
        seen = dedup.stream_first_seen(rows.withWatermark(C.INGESTED_AT, horizon), ["order_id"], salts)
    elif mode == WITHIN:
        seen = dedup.stream_first_seen_within(rows, ["order_id"], C.INGESTED_AT, horizon, salts)
    else:
        raise ValueError(f"mode must be {GLOBAL!r} or {WITHIN!r}, not {mode!r}")
    return silver.with_order_period(seen)
