"""Quality rules of every table and the messages of rejected rows, as data."""

from __future__ import annotations

from basketry import contracts as C
from basketry.operators.quality import DROP, FAIL, WARN, Reason, Rule


def _among(column: str, values: list[str]) -> str:
    return f"{column} IN ({', '.join(repr(v) for v in values)})"


_Q_LOW, _Q_HIGH = C.QUANTITY_RANGE
_D_LOW, _D_HIGH = C.DISCOUNT_RANGE

# --- Fixed values: rule names, predicates and severities --------------------------------------
BRONZE_RULES = [
    Rule("order_id_not_null", "order_id IS NOT NULL"),
    Rule("sales_positive", "sales > 0"),
    Rule("quantity_valid", f"quantity >= {_Q_LOW} AND quantity <= {_Q_HIGH}"),
]

PRODUCT_RULES = [
    Rule("product_id_not_null", "product_id IS NOT NULL"),
    Rule("product_name_not_null", "product_name IS NOT NULL"),
    Rule("category_not_null", "category_of_goods IS NOT NULL"),
    Rule("valid_category", _among("category_of_goods", C.CATEGORIES), WARN),
]

ORDER_DROP_RULES = [
    Rule("order_id_not_null", "order_id IS NOT NULL AND LENGTH(TRIM(order_id)) > 0"),
    Rule("customer_id_not_null", "customer_id IS NOT NULL AND LENGTH(TRIM(customer_id)) > 0"),
    Rule("product_id_not_null", "product_id IS NOT NULL AND LENGTH(TRIM(product_id)) > 0"),
    Rule("sales_positive", f"sales > 0 AND sales <= {C.SALES_CEILING}"),
    Rule("quantity_in_range", f"quantity >= {_Q_LOW} AND quantity <= {_Q_HIGH}"),
    Rule("discount_in_range", f"discount >= {_D_LOW} AND discount <= {_D_HIGH}"),
    Rule("profit_not_null", "profit IS NOT NULL"),
    Rule("order_date_not_null", "order_date IS NOT NULL"),
    Rule("ship_date_not_null", "ship_date IS NOT NULL"),
]

FACT_RULES = [
    Rule("fact_order_id_not_null", "order_id IS NOT NULL", FAIL),
    Rule("fact_customer_id_not_null", "customer_id IS NOT NULL", FAIL),
    Rule("fact_product_id_not_null", "product_id IS NOT NULL", FAIL),
    Rule("fact_sales_positive", "sales > 0", FAIL),
]

# --- Fixed values: messages of rejected rows, first match wins --------------------------------
BRONZE_REASONS = [
    Reason("order_id IS NULL", "order_id IS NULL"),
    Reason("sales is NULL or <= 0", "sales IS NULL OR sales <= 0"),
    Reason(
        "quantity out of range [1, 10]",
        f"quantity IS NULL OR quantity NOT BETWEEN {_Q_LOW} AND {_Q_HIGH}",
    ),
]
BRONZE_OTHER = "unknown"

SILVER_REASONS = [
    Reason("order_id IS NULL", "order_id IS NULL"),
    Reason("sales NULL or non-positive", "sales IS NULL OR sales <= 0"),
    Reason(
        "quantity out of range [1,10]",
        f"quantity IS NULL OR quantity NOT BETWEEN {_Q_LOW} AND {_Q_HIGH}",
    ),
    Reason(
        "discount out of range [0.0, 0.5]",
        f"discount IS NULL OR discount NOT BETWEEN {_D_LOW} AND {_D_HIGH}",
    ),
    Reason("profit IS NULL", "profit IS NULL"),
]
SILVER_OTHER = "other"

# Messages of our own for rows that fail a drop rule but meet none of the conditions above.
SILVER_FURTHER_REASONS = [
    Reason("order_id blank", "LENGTH(TRIM(order_id)) = 0"),
    Reason("customer_id NULL or blank", "customer_id IS NULL OR LENGTH(TRIM(customer_id)) = 0"),
    Reason("product_id NULL or blank", "product_id IS NULL OR LENGTH(TRIM(product_id)) = 0"),
    Reason(f"sales above {C.SALES_CEILING}", f"sales > {C.SALES_CEILING}"),
    Reason("order_date NULL or not a date", "order_date IS NULL"),
    Reason("ship_date NULL or not a date", "ship_date IS NULL"),
]


def customer_rules(as_of: str | None = None, strict: bool = False) -> list[Rule]:
    """Rules of the customer table. ``as_of`` replaces today's date in the birth-date rule.

    The table stores the segment in upper case, so the rule on it compares without regard to case;
    ``strict`` compares the stored text and then warns on every row.
    """
    today = f"DATE '{as_of}'" if as_of else "current_date()"
    segment = _among("segment", C.SEGMENTS) if strict else _among("initcap(segment)", C.SEGMENTS)
    return [
        Rule("customer_id_not_null", "customer_id IS NOT NULL"),
        Rule("first_name_not_null", "first_name IS NOT NULL"),
        Rule(
            "valid_dob",
            f"dob IS NULL OR (dob < {today} AND dob > DATE '{C.EARLIEST_DOB}')",
        ),
        Rule("valid_segment", segment, WARN),
        Rule("valid_city_type", _among("city_type", C.CITY_TYPES), WARN),
        Rule("valid_outlet_type", _among("outlet_type", C.OUTLET_TYPES), WARN),
        Rule("valid_region", _among("region", C.REGIONS), WARN),
    ]


ORDER_WARN_RULES = [
    Rule("ship_after_order", "ship_date >= order_date", WARN),
    Rule("valid_ship_mode", _among("ship_mode", C.SHIP_MODES), WARN),
    Rule("valid_segment", _among("segment", C.SEGMENTS), WARN),
    Rule("valid_region", _among("region", C.REGIONS), WARN),
    Rule("profit_margin_sane", f"try_divide(profit, sales) <= {C.MARGIN_CEILING}", WARN),
]
ORDER_RULES = ORDER_DROP_RULES + ORDER_WARN_RULES

assert all(r.action == DROP for r in ORDER_DROP_RULES)
