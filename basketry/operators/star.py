"""Star join of orders with their dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from basketry import contracts as C
from basketry.functions import dates

# A calendar of up to this many days (several centuries) is a few megabytes and may be broadcast.
BROADCAST_DAYS = 200_000

FACT_FROM_CUSTOMER = ["full_name", "segment", "city_type", "region", "outlet_type", "state"]
FACT_FROM_PRODUCT = ["product_name", "category_of_goods", "sub_category"]
FACT_FROM_DATE = ["year_month", "quarter_label", "is_weekend"]


def star_join(
    orders: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    days: DataFrame,
    n_days: int,
) -> DataFrame:
    """Orders with the current attributes of their customer and product and with calendar columns.

    Left joins: an order without a match keeps NULL attributes. Attributes come from the dimensions,
    not from the order row. ``orders`` may be a stream.

    The customer and product dimensions grow with the data and carry no hint: Spark broadcasts them
    when their size, measured at run time, allows and otherwise uses a sort-merge join, where
    adaptive execution splits the partitions of hot customers and products. The calendar is
    broadcast because its length is known beforehand.
    """
    c = customers.select(
        F.col("customer_id").alias("_customer_id"),
        *[F.col(n).alias(f"c_{n}") for n in FACT_FROM_CUSTOMER],
    )
    p = products.select(
        F.col("product_id").alias("_product_id"),
        *[F.col(n).alias(f"p_{n}") for n in FACT_FROM_PRODUCT],
    )
    d = days.select("full_date", "date_key", *[F.col(n).alias(f"d_{n}") for n in FACT_FROM_DATE])
    if n_days <= BROADCAST_DAYS:
        d = F.broadcast(d)
    joined = (
        orders.join(c, F.col("customer_id") == F.col("_customer_id"), "left")
        .join(p, F.col("product_id") == F.col("_product_id"), "left")
        .join(d, F.col("order_date") == F.col("full_date"), "left")
    )
    return joined.select(
        "order_id", "customer_id", "product_id", "date_key",
        "order_date", "ship_date", "sales_date",
        "sales", "quantity", "discount", "profit", "net_sales", "profit_margin_pct",
        "shipping_days", "ship_mode",
        *[F.col(f"c_{n}").alias(n) for n in FACT_FROM_CUSTOMER],
        *[F.col(f"p_{n}").alias(n) for n in FACT_FROM_PRODUCT],
        *[F.col(f"d_{n}").alias(n) for n in FACT_FROM_DATE],
        dates.text_year("order_date").alias("order_year"),
        C.SOURCE_FILE, C.INGESTED_AT,
    )


def unmatched(fact: DataFrame) -> DataFrame:
    """How many fact rows found no customer, product or day: one row per dimension."""
    counts = fact.agg(
        F.count(F.lit(1)).alias("_rows"),
        F.count_if(F.col("full_name").isNull()).alias(C.DIM_CUSTOMER),
        F.count_if(F.col("product_name").isNull()).alias(C.DIM_PRODUCT),
        F.count_if(F.col("date_key").isNull()).alias(C.DIM_DATE),
    )
    lines = F.array(
        *[
            F.struct(
                F.lit(name).alias("dimension"),
                (F.col("_rows") - F.col(name)).alias("matched"),
                F.col(name).alias("unmatched"),
            )
            for name in (C.DIM_CUSTOMER, C.DIM_PRODUCT, C.DIM_DATE)
        ]
    )
    return counts.select(F.inline(lines))
