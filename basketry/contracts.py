"""Names, types and rule texts that form the data contract."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# --- Fixed values: the raw feed, in file order: header, type, column name -------------------
RAW_FIELDS = [
    ("Customer ID", "string", "customer_id"),
    ("Customer Name", "string", "first_name"),
    ("Last Name", "string", "last_name"),
    ("Date of Birth", "string", "date_of_birth_raw"),
    ("Sales", "double", "sales"),
    ("Year", "int", "year"),
    ("Outlet Type", "string", "outlet_type"),
    ("City Type", "string", "city_type"),
    ("Category of Goods", "string", "category_of_goods"),
    ("Region", "string", "region"),
    ("Country", "string", "country"),
    ("Segment", "string", "segment"),
    ("Sales Date", "string", "sales_date_raw"),
    ("Order ID", "string", "order_id"),
    ("Order Date", "string", "order_date_raw"),
    ("Ship Date", "string", "ship_date_raw"),
    ("Ship Mode", "string", "ship_mode"),
    ("State", "string", "state"),
    ("Postal Code", "bigint", "postal_code"),
    ("Product ID", "string", "product_id"),
    ("Sub-Category", "string", "sub_category"),
    ("Product Name", "string", "product_name"),
    ("Quantity", "int", "quantity"),
    ("Discount", "double", "discount"),
    ("Profit", "double", "profit"),
]

RESCUED = "_rescued_data"
SOURCE_FILE = "_source_file"
INGESTED_AT = "_ingestion_ts"
INGEST_YEAR = "_ingestion_year"
INGEST_MONTH = "_ingestion_month"
FILE_MODIFIED = "_file_modification_time"
REFRESHED_AT = "_gold_updated_ts"
START_AT = "__START_AT"
END_AT = "__END_AT"

# --- Fixed values: table names ----------------------------------------------------------------
BRONZE_SALES = "bronze_raw_sales"
BRONZE_QUARANTINE = "bronze_quarantine"
SILVER_CUSTOMERS = "silver_customers_clean"
SILVER_PRODUCTS = "silver_products_clean"
SILVER_ORDERS = "silver_orders_clean"
SILVER_QUARANTINE = "silver_quarantine"
# Ours: orders behind the watermark, and how many rows kept each rule, by batch.
LATE_ORDERS = "silver_orders_late"
RULE_REPORT = "rule_report"
DIM_CUSTOMER = "gold_dim_customer"
DIM_PRODUCT = "gold_dim_product"
DIM_DATE = "gold_dim_date"
FACT_SALES = "gold_fact_sales"
KPI_REGION_CATEGORY = "gold_kpi_sales_by_region_category"
KPI_SEGMENT = "gold_kpi_customer_segment_performance"
KPI_PRODUCT = "gold_kpi_product_performance"
KPI_MONTHLY = "gold_kpi_monthly_sales_trend"
KPI_OUTLET_CITY = "gold_kpi_outlet_city_analysis"


@dataclass(frozen=True)
class TableInfo:
    """What a table is: its layer tag, what one row stands for, how it is partitioned."""

    quality: str
    comment: str
    partition_by: tuple[str, ...] = ()


# --- Fixed values: layer tags and partition columns; the comments are ours --------------------
TABLES = {
    BRONZE_SALES: TableInfo("bronze", "Feed rows that pass the bronze rules, append only",
                            (INGEST_YEAR, INGEST_MONTH)),
    BRONZE_QUARANTINE: TableInfo("quarantine", "Feed rows that fail a bronze rule, with reason"),
    SILVER_CUSTOMERS: TableInfo("silver", "Cleansed customers, one row each"),
    SILVER_PRODUCTS: TableInfo("silver", "Cleansed products, one row each"),
    SILVER_ORDERS: TableInfo("silver", "Cleansed orders, one row each", ("order_year",)),
    SILVER_QUARANTINE: TableInfo("quarantine", "Bronze rows kept out of the orders, with reason"),
    DIM_CUSTOMER: TableInfo("gold", "Customer versions with their validity"),
    DIM_PRODUCT: TableInfo("gold", "Product versions with their validity"),
    DIM_DATE: TableInfo("gold", "Calendar, one row per day"),
    FACT_SALES: TableInfo("gold", "Orders with dimension attributes", ("order_year",)),
    KPI_REGION_CATEGORY: TableInfo("gold", "Sales by region, category and year"),
    KPI_SEGMENT: TableInfo("gold", "Sales by customer segment, city type, outlet type and year"),
    KPI_PRODUCT: TableInfo("gold", "Sales by product with rank in the category"),
    KPI_MONTHLY: TableInfo("gold", "Monthly sales by region and category with growth"),
    KPI_OUTLET_CITY: TableInfo("gold", "Sales by outlet type, city type, region and year"),
}

# --- Fixed values: value domains, case-sensitive ----------------------------------------------
SEGMENTS = ["Consumer", "Corporate"]
CITY_TYPES = ["Tier 1", "Tier 2", "Village"]
OUTLET_TYPES = ["Large", "Medium", "Small"]
REGIONS = ["East", "South", "West", "North"]
SHIP_MODES = ["Same Day", "Standard Class", "Second Class", "First Class"]
CATEGORIES = [
    "Fast Food",
    "Electric Appliances",
    "Dairy Products",
    "Sessional Fruits & Vegetables",
    "Furniture",
    "Household Items",
]

# --- Fixed values: limits ---------------------------------------------------------------------
QUANTITY_RANGE = (1, 10)
DISCOUNT_RANGE = (0.0, 0.5)
SALES_CEILING = 100000
MARGIN_CEILING = 5.0
EARLIEST_DOB = "1900-01-01"
SPINE_BOUNDS = ("2015-01-01", "2025-12-31")
LATE_HORIZON = "24 hours"
MAX_FILES_PER_TRIGGER = 1000
# Ours: the reads of stored tables have a limit too.
MAX_BYTES_PER_TRIGGER = 256 << 30

# --- Fixed values: stored columns of the dimensions -------------------------------------------
DIM_CUSTOMER_COLUMNS = [
    "customer_id", "first_name", "last_name", "full_name", "dob", "segment", "city_type",
    "region", "outlet_type", "state", "country", SOURCE_FILE,
]
DIM_PRODUCT_COLUMNS = [
    "product_id", "product_name", "sub_category", "category_of_goods", SOURCE_FILE,
]

# Ours: columns of the feed whose values hardly repeat, or are long; stored without a dictionary.
VARIED_COLUMNS = ["order_id", "customer_id", "product_id", "first_name", "product_name", "sales", "profit",
                  "postal_code", SOURCE_FILE]

RENAMES = {header: name for header, _, name in RAW_FIELDS}
FEED_COLUMNS = [name for _, _, name in RAW_FIELDS]


def raw_schema() -> T.StructType:
    """Typed schema of the feed, keyed by header; every field is nullable."""
    return T.StructType.fromDDL(", ".join(f"`{header}` {kind}" for header, kind, _ in RAW_FIELDS))


def feed_schema() -> T.StructType:
    """Typed schema of the feed after renaming."""
    return T.StructType.fromDDL(", ".join(f"`{name}` {kind}" for _, kind, name in RAW_FIELDS))
