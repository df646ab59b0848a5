"""The raw sales feed derived from the test tables."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, functions as F

from basketry import contracts as C
from basketry.session import beside

# Columns of the test tables. Stating them saves a job per read to look them up.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
            "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
              "value double, props string",
}
TABLES = list(SCHEMAS)

# Beyond the feed, columns that only serve to put rows of one order in a total order.
TIEBREAK_EXTRA = ("l_linenumber", "l_suppkey", "l_returnflag", "l_linestatus")
FIRST_BY = ("sales", "product_id", "quantity", "discount", "profit", "ship_date",
            *TIEBREAK_EXTRA)

INGESTED = "2026-01-15 06:00:00"
SOURCE_NAME = "landing/sales.csv"

# One text for both engines: ``{text}`` is the engine's string type, ``{years}`` its 20-year interval.
RAW_SQL = """
select
  case when l_linenumber = 7 and l_returnflag = 'R' then null
       else concat('O-', cast(l_orderkey as {text})) end as order_id,
  concat('C-', cast(c_custkey as {text})) as customer_id,
  concat('P-', cast(p_partkey as {text})) as product_id,
  c_name as first_name,
  concat('Family ', cast(c_nationkey as {text})) as last_name,
  case when c_custkey % 97 = 0 then 'unknown'
       else concat(cast(1950 + c_custkey % 50 as {text}), '-0',
                   cast(1 + c_custkey % 9 as {text}), '-1', cast(c_custkey % 10 as {text})) end
    as date_of_birth_raw,
  r_name as region, n_name as country, n_name as state, c_mktsegment as segment,
  case c_nationkey % 3 when 0 then 'Tier 1' when 1 then 'Tier 2' else 'Village' end as city_type,
  case when c_acctbal < 2500 then 'Small' when c_acctbal < 6000 then 'Medium' else 'Large' end
    as outlet_type,
  p_type as category_of_goods, p_brand as sub_category, p_name as product_name,
  case o_orderpriority when '1-URGENT' then 'Same Day' when '2-HIGH' then 'First Class'
       when '3-MEDIUM' then 'Second Class' else 'Standard Class' end as ship_mode,
  case when l_linenumber = 6 and l_linestatus = 'F' then 'bad-date'
       else cast(cast(o_orderdate + {years} as date) as {text}) end as order_date_raw,
  cast(cast(l_shipdate + {years} as date) as {text}) as ship_date_raw,
  cast(cast(o_orderdate + {years} as date) as {text}) as sales_date_raw,
  cast(extract(year from o_orderdate) + 20 as int) as year,
  cast(10000 + c_custkey as bigint) as postal_code,
  l_extendedprice as sales, cast(l_quantity as int) as quantity,
  cast(cast(l_discount as decimal(4,2)) * 6 as double) as discount,
  case when l_linenumber = 5 and l_returnflag = 'A' then null
       else cast(cast(cast(l_extendedprice as decimal(18,2))
            * (cast(l_tax as decimal(4,2)) + cast(0.05 as decimal(4,2))
               - cast(l_discount as decimal(4,2))) as decimal(18,2)) as double) end as profit,
  l_linenumber, l_suppkey, l_returnflag, l_linestatus
from {lineitem}
join {orders} on l_orderkey = o_orderkey
join {customer} on o_custkey = c_custkey
join {nation} on c_nationkey = n_nationkey
join {region} on n_regionkey = r_regionkey
join {part} on l_partkey = p_partkey
"""
# The same joins in the order that suits Spark, which keeps it where it cannot broadcast: the order lines
# are shuffled twice, first while they are narrow, and customers are looked up once per order.
JOINED = """
from {lineitem} join {part} on l_partkey = p_partkey
join ({orders} join {customer} on o_custkey = c_custkey
      join {nation} on c_nationkey = n_nationkey
      join {region} on n_regionkey = r_regionkey) on l_orderkey = o_orderkey
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(os.path.join(sf_dir, f"{name}.parquet"))


def raw_sales(spark: SparkSession, sf_dir: str, slices: int = 1, number: int = 0) -> DataFrame:
    """The feed, already renamed, plus the tiebreak columns; of several slices, the orders of one."""
    names = ("lineitem", "orders", "customer", "nation", "region", "part")
    columns, _, _ = RAW_SQL.partition("from {lineitem}")
    text = columns.replace("{text}", "string").replace("{years}", "interval '20' year")
    named = {n: table(spark, sf_dir, n) for n in names}
    if slices > 1:
        for name, key in (("lineitem", "l_orderkey"), ("orders", "o_orderkey")):
            named[name] = named[name].filter(F.pmod(F.xxhash64(key), F.lit(slices)) == number)
    return spark.sql(text + JOINED, **named)


def raw_slices(spark: SparkSession, sf_dir: str, slices: int = 1) -> list[DataFrame]:
    """The feed in slices of its orders, to be written one after the other. What the joins behind a write have
    shuffled is removed when it ends, so the disks hold that of one slice. Each slice scans the tables anew."""
    session = beside(spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"})
    return [raw_sales(session, sf_dir, slices, number) for number in range(slices)]


def raw_with_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed with fixed audit columns, as the CSV source would deliver it."""
    at = F.lit(INGESTED).cast("timestamp")
    return raw_sales(spark, sf_dir).withColumns(
        {
            C.RESCUED: F.lit(None).cast("string"),
            C.SOURCE_FILE: F.lit(SOURCE_NAME),
            C.INGESTED_AT: at,
            C.INGEST_YEAR: F.year(at).cast("string"),
            C.INGEST_MONTH: F.month(at).cast("string"),
            C.FILE_MODIFIED: at,
        }
    )
