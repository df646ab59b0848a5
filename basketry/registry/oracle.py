"""SQL counterparts of the registered queries, for DuckDB."""

from __future__ import annotations

from basketry.sources.testtables import RAW_SQL, SOURCE_NAME, TABLES

_RAW = RAW_SQL.replace("{text}", "varchar").replace("{years}", "interval 20 year")
for _name in TABLES:
    _RAW = _RAW.replace("{" + _name + "}", _name)


def rnd(expression: str, digits: int) -> str:
    """Round the shortest decimal form half up, as Spark's ``round`` on doubles does."""
    return (
        f"cast(round(cast(cast({expression} as varchar) as decimal(38,18)), {digits}) as double)"
    )


def day(text: str) -> str:
    return f"cast(try_strptime({text}, '%Y-%m-%d') as date)"


def total(column: str) -> str:
    return f"cast(sum(cast({column} as decimal(24,6))) as double)"


def mean(column: str, digits: int) -> str:
    return rnd(f"({total(column)} / nullif(count({column}), 0))", digits)


def instant(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S.%f')"


SHIP_MODES = "('Same Day', 'Standard Class', 'Second Class', 'First Class')"
ORDER_OK = """
  length(trim(order_id)) > 0 and length(trim(customer_id)) > 0 and length(trim(product_id)) > 0
  and sales > 0 and sales <= 100000 and quantity between 1 and 10
  and discount between 0.0 and 0.5 and profit is not null
  and order_date is not null and ship_date is not null
"""
FIRST_BY = """
  sales nulls last, product_id nulls last, quantity nulls last, discount nulls last,
  profit nulls last, ship_date nulls last, l_linenumber, l_suppkey, l_returnflag, l_linestatus
"""
ORDER_COLUMNS = """
  order_id, customer_id, product_id, order_date, ship_date, sales_date, sales, quantity, discount,
  profit, net_sales, profit_margin_pct, shipping_days, segment, ship_mode, outlet_type, city_type,
  region, state, country, postal_code, category_of_goods, sub_category, product_name, year,
  order_year, order_month
"""
CUSTOMER_COLUMNS = """
  customer_id, first_name, last_name, full_name, dob, segment, city_type, region, outlet_type,
  state, country
"""
PRODUCT_COLUMNS = "product_id, product_name, sub_category, category_of_goods"
FACT_COLUMNS = """
  order_id, customer_id, product_id, date_key, order_date, ship_date, sales_date, sales, quantity,
  discount, profit, net_sales, profit_margin_pct, shipping_days, ship_mode, full_name, segment,
  city_type, region, outlet_type, state, product_name, category_of_goods, sub_category,
  year_month, quarter_label, is_weekend, order_year
"""


def date_columns(d: str) -> str:
    return f"""
  strftime({d}, '%Y%m%d') as date_key, {d} as full_date,
  cast(year({d}) as int) as year, cast(quarter({d}) as int) as quarter,
  cast(month({d}) as int) as month,
  strftime({d}, '%B') as month_name, strftime({d}, '%b') as month_short,
  cast(weekofyear({d}) as int) as week_of_year, cast(day({d}) as int) as day_of_month,
  cast(dayofweek({d}) + 1 as int) as day_of_week,
  strftime({d}, '%A') as day_name, strftime({d}, '%a') as day_short,
  dayofweek({d}) in (0, 6) as is_weekend, dayofweek({d}) not in (0, 6) as is_weekday,
  strftime({d}, '%Y-%m') as year_month,
  'Q' || quarter({d}) || '-' || year({d}) as quarter_label"""


def spine(first: str, last: str) -> str:
    return (
        f"select {date_columns('d')} from (select cast(range as date) as d from "
        f"range(date '{first}', date '{last}' + interval 1 day, interval 1 day))"
    )


def star(customers: str, products: str, days: str) -> str:
    return f"""
select o.order_id, o.customer_id, o.product_id, d.date_key, o.order_date, o.ship_date,
  o.sales_date, o.sales, o.quantity, o.discount, o.profit, o.net_sales, o.profit_margin_pct,
  o.shipping_days, o.ship_mode, c.full_name, c.segment, c.city_type, c.region, c.outlet_type,
  c.state, p.product_name, p.category_of_goods, p.sub_category, d.year_month, d.quarter_label,
  d.is_weekend, cast(year(o.order_date) as varchar) as order_year
from orders_clean o
left join {customers} c on o.customer_id = c.customer_id
left join {products} p on o.product_id = p.product_id
left join {days} d on o.order_date = d.full_date"""


CTES = {
    "raw": _RAW,
    "bronze": """
select * from raw where order_id is not null and sales > 0 and quantity >= 1 and quantity <= 10""",
    "order_rows": f"""
select trim(order_id) as order_id, trim(customer_id) as customer_id,
  trim(product_id) as product_id, {day('order_date_raw')} as order_date,
  {day('ship_date_raw')} as ship_date, {day('sales_date_raw')} as sales_date,
  sales, quantity, discount, profit,
  {rnd('sales * (1 - discount)', 2)} as net_sales,
  case when sales > 0 then {rnd('(profit / sales)', 4)} end as profit_margin_pct,
  cast(date_diff('day', {day('order_date_raw')}, {day('ship_date_raw')}) as int) as shipping_days,
  trim(segment) as segment, trim(ship_mode) as ship_mode, trim(outlet_type) as outlet_type,
  trim(city_type) as city_type, trim(region) as region, trim(state) as state,
  trim(country) as country, postal_code, trim(category_of_goods) as category_of_goods,
  trim(sub_category) as sub_category, trim(product_name) as product_name, year,
  cast(year({day('order_date_raw')}) as varchar) as order_year,
  cast(month({day('order_date_raw')}) as varchar) as order_month,
  l_linenumber, l_suppkey, l_returnflag, l_linestatus
from bronze""",
    "orders_ok": f"select * from order_rows where {ORDER_OK}",
    "orders_clean": f"""
select {ORDER_COLUMNS} from (
  select *, row_number() over (partition by order_id order by {FIRST_BY}) as rn from orders_ok)
where rn = 1""",
    "customer_rows": f"""
select trim(customer_id) as customer_id, trim(first_name) as first_name,
  trim(last_name) as last_name,
  concat_ws(' ', trim(first_name), trim(last_name)) as full_name,
  {day('date_of_birth_raw')} as dob, upper(trim(segment)) as segment,
  trim(city_type) as city_type, trim(region) as region, trim(outlet_type) as outlet_type,
  trim(state) as state, trim(country) as country, {day('order_date_raw')} as order_date
from bronze""",
    "customers": f"select distinct {CUSTOMER_COLUMNS} from customer_rows",
    "product_rows": f"""
select trim(product_id) as product_id, trim(product_name) as product_name,
  trim(sub_category) as sub_category, trim(category_of_goods) as category_of_goods,
  {day('order_date_raw')} as order_date
from bronze""",
    "products": f"select distinct {PRODUCT_COLUMNS} from product_rows",
    "spine": spine("2015-01-01", "2025-12-31"),
    "fact": star("customers", "products", "spine"),
    "kpi_region_category": f"""
select region, category_of_goods, order_year,
  {rnd(total('sales'), 2)} as total_sales, {rnd(total('profit'), 2)} as total_profit,
  {rnd(total('net_sales'), 2)} as total_net_sales,
  count(distinct order_id) as total_orders, cast(sum(quantity) as bigint) as total_quantity,
  {mean('discount', 4)} as avg_discount, {mean('profit_margin_pct', 4)} as avg_profit_margin,
  {rnd(f"({total('profit')} / {total('sales')})", 4)} as overall_margin
from fact group by all""",
    "kpi_segment": f"""
select segment, city_type, outlet_type, order_year,
  count(distinct customer_id) as unique_customers, count(distinct order_id) as total_orders,
  {rnd(total('sales'), 2)} as total_sales, {rnd(total('profit'), 2)} as total_profit,
  {mean('sales', 2)} as avg_order_value,
  {rnd(f"({total('sales')} / count(distinct customer_id))", 2)} as avg_revenue_per_customer,
  {rnd("avg(shipping_days)", 1)} as avg_shipping_days, {mean('discount', 4)} as avg_discount
from fact group by all""",
    "product_totals": f"""
select product_id, sub_category, category_of_goods,
  count(distinct order_id) as total_orders, cast(sum(quantity) as bigint) as total_quantity_sold,
  {rnd(total('sales'), 2)} as total_sales, {rnd(total('profit'), 2)} as total_profit,
  {mean('sales', 2)} as avg_order_sales, {mean('profit_margin_pct', 4)} as avg_profit_margin,
  {mean('discount', 4)} as avg_discount, count(distinct customer_id) as unique_customers
from fact group by all""",
    "kpi_product": """
select *, cast(rank() over (partition by category_of_goods order by total_sales desc) as int)
  as sales_rank_in_category
from product_totals""",
    "monthly": f"""
select year_month, region, category_of_goods,
  {rnd(total('sales'), 2)} as monthly_sales, {rnd(total('profit'), 2)} as monthly_profit,
  count(distinct order_id) as monthly_orders, cast(sum(quantity) as bigint) as monthly_quantity,
  {mean('discount', 4)} as avg_discount
from fact group by all""",
    "monthly_lag": """
select *, lag(monthly_sales) over w as prev_month_sales, lag(year_month) over w as prev_month
from monthly window w as (partition by region, category_of_goods order by year_month nulls first)""",
    "kpi_monthly_trend": f"""
select * exclude (prev_month), case when prev_month_sales > 0 then
  {rnd('((monthly_sales - prev_month_sales) / prev_month_sales * 100)', 2)} end as mom_growth_pct
from monthly_lag""",
    "calendar_lag": """
select * exclude (prev_month) replace (
  case when strftime(cast(prev_month || '-01' as date) + interval 1 month, '%Y-%m') = year_month
       then prev_month_sales end as prev_month_sales)
from monthly_lag""",
    "kpi_outlet_city": f"""
select outlet_type, city_type, region, order_year,
  count(distinct order_id) as total_orders, count(distinct customer_id) as unique_customers,
  {rnd(total('sales'), 2)} as total_sales, {rnd(total('profit'), 2)} as total_profit,
  {mean('sales', 2)} as avg_order_value, {mean('profit_margin_pct', 4)} as avg_profit_margin,
  {rnd(f"({total('profit')} / {total('sales')} * 100)", 2)} as profit_pct,
  {rnd("avg(shipping_days)", 1)} as avg_shipping_days,
  {rnd("(count(*) filter (where ship_mode = 'Same Day') / count(*) * 100)", 1)} as pct_same_day,
  {rnd("(count(*) filter (where ship_mode = 'Standard Class') / count(*) * 100)", 1)}
    as pct_standard_class
from fact group by all""",
    "shipped": """
select *, ship_date >= date '2018-07-01' or l_linenumber = 3 as second from orders_ok""",
    "shipped_mark": """
select max(ship_date) - interval 200 day as mark from shipped where not second""",
    "history": """
select user_id, event_type, value, ts as start_ts,
  lead(ts) over (partition by user_id order by ts) as end_ts
from (select *, lag(event_type) over (partition by user_id order by ts) as before,
             row_number() over (partition by user_id order by ts) as nth
      from events)
where nth = 1 or event_type is distinct from before""",
}


def query(select: str) -> str:
    """``select`` over the tables above, with just those it needs put in front."""
    import re

    needed, todo = set(), [select]
    while todo:
        words = set(re.findall(r"[a-z_0-9]+", todo.pop()))
        for name in CTES:
            if name in words and name not in needed:
                needed.add(name)
                todo.append(CTES[name])
    if not needed:
        return select
    parts = [f"{name} as ({CTES[name]})" for name in CTES if name in needed]
    return "with " + ",\n".join(parts) + "\n" + select


BRONZE_REASON = """case when order_id is null then 'order_id IS NULL'
  when sales is null or sales <= 0 then 'sales is NULL or <= 0'
  when quantity is null or quantity < 1 or quantity > 10 then 'quantity out of range [1, 10]'
  else 'unknown' end"""
BRONZE_BAD = """order_id is null or sales is null or sales <= 0 or quantity is null
  or quantity < 1 or quantity > 10"""
SILVER_SUBSET = """sales is null or sales <= 0 or quantity is null or quantity < 1 or quantity > 10
  or discount is null or discount < 0 or discount > 0.5 or profit is null"""
SILVER_REASON = """case when sales is null or sales <= 0 then 'sales NULL or non-positive'
  when quantity is null or quantity < 1 or quantity > 10 then 'quantity out of range [1,10]'
  when discount is null or discount < 0 or discount > 0.5
    then 'discount out of range [0.0, 0.5]'
  when profit is null then 'profit IS NULL'
  when length(trim(customer_id)) = 0 then 'customer_id NULL or blank'
  when length(trim(product_id)) = 0 then 'product_id NULL or blank'
  when sales > 100000 then 'sales above 100000'
  when order_date is null then 'order_date NULL or not a date'
  when ship_date is null then 'ship_date NULL or not a date'
  else 'other' end"""
SILVER_VIOLATIONS = """concat_ws('|',
  case when not (sales > 0 and sales <= 100000) then 'sales_positive' end,
  case when not (discount between 0.0 and 0.5) then 'discount_in_range' end,
  case when profit is null then 'profit_not_null' end,
  case when order_date is null then 'order_date_not_null' end,
  case when ship_date is null then 'ship_date_not_null' end)"""
BRONZE_VIOLATIONS = """concat_ws('|',
  case when order_id is null then 'order_id_not_null' end,
  case when not coalesce(sales > 0, false) then 'sales_positive' end,
  case when not coalesce(quantity between 1 and 10, false) then 'quantity_valid' end)"""

DATED = """(select o_orderkey, cast(o_orderdate + interval 20 year as date) as d from orders)"""


def _report(table: str, source: str, rules: list[tuple[str, str, str]]) -> str:
    return "\nunion all\n".join(
        f"select '{table}' as table_name, '{name}' as rule_name, '{action}' as action, "
        f"count(*) filter (where coalesce({predicate}, false)) as passed, "
        f"count(*) filter (where not coalesce({predicate}, false)) as failed from {source}"
        for name, action, predicate in rules
    )


_BRONZE_RULES = [
    ("order_id_not_null", "drop", "order_id is not null"),
    ("sales_positive", "drop", "sales > 0"),
    ("quantity_valid", "drop", "quantity between 1 and 10"),
]
_CUSTOMER_DROPS = [
    ("customer_id_not_null", "drop", "customer_id is not null"),
    ("first_name_not_null", "drop", "first_name is not null"),
    ("valid_dob", "drop", "dob is null or (dob < date '1990-01-01' and dob > date '1900-01-01')"),
]
_CUSTOMER_WARNS = [
    ("valid_segment", "warn", "segment in ('CONSUMER', 'CORPORATE')"),
    ("valid_city_type", "warn", "city_type in ('Tier 1', 'Tier 2', 'Village')"),
    ("valid_outlet_type", "warn", "outlet_type in ('Large', 'Medium', 'Small')"),
    ("valid_region", "warn", "region in ('East', 'South', 'West', 'North')"),
]
_PRODUCT_DROPS = [
    ("product_id_not_null", "drop", "product_id is not null"),
    ("product_name_not_null", "drop", "product_name is not null"),
    ("category_not_null", "drop", "category_of_goods is not null"),
]
_CATEGORY_LIST = (
    "('Fast Food', 'Electric Appliances', 'Dairy Products', 'Sessional Fruits & Vegetables', "
    "'Furniture', 'Household Items')"
)
_PRODUCT_WARNS = [("valid_category", "warn", f"category_of_goods in {_CATEGORY_LIST}")]
_ORDER_DROPS = [
    ("order_id_not_null", "drop", "length(trim(order_id)) > 0"),
    ("customer_id_not_null", "drop", "length(trim(customer_id)) > 0"),
    ("product_id_not_null", "drop", "length(trim(product_id)) > 0"),
    ("sales_positive", "drop", "sales > 0 and sales <= 100000"),
    ("quantity_in_range", "drop", "quantity between 1 and 10"),
    ("discount_in_range", "drop", "discount between 0.0 and 0.5"),
    ("profit_not_null", "drop", "profit is not null"),
    ("order_date_not_null", "drop", "order_date is not null"),
    ("ship_date_not_null", "drop", "ship_date is not null"),
]
_ORDER_WARNS = [
    ("ship_after_order", "warn", "ship_date >= order_date"),
    ("valid_ship_mode", "warn", f"ship_mode in {SHIP_MODES}"),
    ("valid_segment", "warn", "segment in ('Consumer', 'Corporate')"),
    ("valid_region", "warn", "region in ('East', 'South', 'West', 'North')"),
    ("profit_margin_sane", "warn", "profit / sales <= 5.0"),
]
_FACT_RULES = [
    ("fact_order_id_not_null", "fail", "order_id is not null"),
    ("fact_customer_id_not_null", "fail", "customer_id is not null"),
    ("fact_product_id_not_null", "fail", "product_id is not null"),
    ("fact_sales_positive", "fail", "sales > 0"),
]

_CUSTOMERS_BORN_BEFORE = (
    "(select * from customers where dob is null "
    "or (dob < date '1990-01-01' and dob > date '1900-01-01'))"
)
_SHORT_SPINE = f"({spine('2015-01-01', '2019-12-31')})"
_HISTORY_OUT = (
    f"select user_id, event_type, {instant('start_ts')} as start_at, "
    f"{instant('end_ts')} as end_at from history"
)
_FEED = """order_id, customer_id, product_id, first_name, last_name, date_of_birth_raw, region,
  country, state, segment, city_type, outlet_type, category_of_goods, sub_category, product_name,
  ship_mode, order_date_raw, ship_date_raw, sales_date_raw, year, postal_code, sales, quantity,
  discount, profit"""


def _scd(rows: str, key: str, columns: str) -> str:
    # Attributes depend on the key alone, so each key has one version, opened by its first date.
    return f"""select {columns}, '{SOURCE_NAME}' as _source_file, min(order_date) as "__START_AT",
  cast(null as date) as "__END_AT" from {rows} where order_date is not null
  and {key} is not null group by all"""


SELECTS: dict[str, str] = {
    # sources and sinks
    "src_csv_incremental": f"select {_FEED} from raw",
    "src_file_metadata": """
        select case when l_returnflag = 'R' then 'second' else 'first' end as folder,
               count(*) as n, true as time_is_set
        from raw group by 1""",
    "src_csv_header_by_name": f"select {_FEED} from raw",
    "src_explicit_schema": "select order_id, year, postal_code, quantity, sales, discount, profit "
                           "from raw",
    "src_rescued_data": """select order_id, customer_id, product_id,
  case when quantity > 40 then null else quantity end as quantity,
  case when quantity > 40 then quantity || ' pcs' end as rescued_quantity,
  l_returnflag as rescued_flag from raw""",
    "src_max_files_per_trigger": f"select {_FEED} from raw",
    "src_trigger_available_now": f"select {_FEED} from raw",
    "src_audit_columns": """select order_id, '2026-01-15 06:00:00' as ingested_at,
  '2026' as _ingestion_year, '1' as _ingestion_month from raw""",
    "sink_partitioned_append": f"""select order_year, count(*) as n,
  {rnd(total('sales'), 2)} as sales from orders_ok group by all""",
    "sink_recompute": "select * from kpi_region_category",
    # projections, filters, scalars
    "proj_rename_columns": f"select {_FEED} from raw",
    "proj_select_alias": "select order_id as id, product_id as item, sales as amount from raw",
    "proj_derived": f"""select order_id, sales_date_raw,
  cast(year({day('sales_date_raw')}) as varchar) as sales_year,
  cast(month({day('sales_date_raw')}) as varchar) as sales_month from raw""",
    "scalar_cast": """select order_id, cast(quantity as double) as quantity_double,
  cast(year as varchar) as year_text, try_cast(order_date_raw as date) as day from raw""",
    "scalar_trim": """select order_id, trim(' ' || product_name || '  ') as product_name,
  trim('  ' || segment) as segment from raw""",
    "scalar_trim_upper": "select customer_id, upper(trim(segment)) as segment from raw",
    "scalar_concat_ws": """select customer_id, concat_ws(' ', trim(first_name),
  case when l_returnflag = 'R' then null else trim(last_name) end) as full_name from raw""",
    "date_quarter_label": f"""select o_orderkey,
  'Q' || quarter(d) || '-' || year(d) as quarter_label from {DATED}""",
    "pred_not_blank": """select order_id, customer_id from raw
where order_id is not null and length(trim(order_id)) > 0""",
    "scalar_parse_date": f"""select order_id, {day('order_date_raw')} as order_date,
  {day('ship_date_raw')} as ship_date from raw""",
    "scalar_datediff": f"""select order_id, cast(date_diff('day', {day('order_date_raw')},
  {day('ship_date_raw')}) as int) as shipping_days from raw""",
    "date_parts": f"""select o_orderkey, cast(year(d) as int) as year,
  cast(quarter(d) as int) as quarter, cast(month(d) as int) as month,
  cast(weekofyear(d) as int) as week_of_year, cast(day(d) as int) as day_of_month,
  cast(dayofweek(d) + 1 as int) as day_of_week from {DATED}""",
    "date_format_patterns": f"""select o_orderkey, strftime(d, '%Y%m%d') as date_key,
  strftime(d, '%B') as month_name, strftime(d, '%b') as month_short, strftime(d, '%A') as day_name,
  strftime(d, '%a') as day_short, strftime(d, '%Y-%m') as year_month from {DATED}""",
    "date_weekend_flags": f"""select o_orderkey, dayofweek(d) in (0, 6) as is_weekend,
  dayofweek(d) not in (0, 6) as is_weekday from {DATED}""",
    "date_spine": f"""select spine.*, coalesce(n, 0) as n_orders from spine
left join (select d, count(*) as n from {DATED} group by all) x on spine.full_date = x.d""",
    "scalar_round": f"""select order_id, {rnd('sales / 7', 1)} as r1, {rnd('sales / 7', 2)} as r2,
  {rnd('discount / 7', 4)} as r4 from raw""",
    "scalar_net_sales": f"select order_id, {rnd('sales * (1 - discount)', 2)} as net_sales from raw",
    "scalar_margin_guarded": f"""select order_id, case when sales > 0 then
  {rnd('(profit / sales)', 4)} end as profit_margin_pct,
  case when profit > 0 then {rnd('(sales / profit)', 4)} end as sales_per_profit from raw""",
    "case_first_reason": f"select order_id, quantity, {BRONZE_REASON} as reason from raw",
    "filter_compound_null": f"select order_id, sales, quantity, profit from raw "
                            f"where (order_id is null or profit is null) and quantity > 10",
    "pred_range": "select order_id, quantity, discount from raw "
                  "where quantity between 1 and 10 and discount between 0.0 and 0.5",
    "pred_in_list": "select order_id, ship_mode, city_type from raw where ship_mode in "
                    "('Same Day', 'First Class') and city_type in ('Tier 1', 'Tier 2')",
    "pred_valid_dob": f"""select customer_id, {day('date_of_birth_raw')} as dob from raw
where {day('date_of_birth_raw')} is null or ({day('date_of_birth_raw')} < date '1990-01-01'
  and {day('date_of_birth_raw')} > date '1900-01-01')""",
    # data quality
    "dq_drop_bronze": "select order_id, product_id, sales, quantity from bronze",
    "dq_drop_customers": """select customer_id, first_name, dob from customer_rows
where dob is null or (dob < date '1990-01-01' and dob > date '1900-01-01')""",
    "dq_drop_products": "select product_id, product_name, category_of_goods from product_rows",
    "dq_drop_orders": "select order_id, customer_id, product_id, sales, quantity, discount, profit, "
                      "order_date, ship_date from orders_ok",
    "dq_warn_metrics": "\nunion all\n".join([
        _report("silver_customers_clean", "customer_rows", _CUSTOMER_WARNS),
        _report("silver_products_clean", "product_rows", _PRODUCT_WARNS),
        _report("silver_orders_clean", "order_rows", _ORDER_WARNS)]),
    "dq_fail_passes_clean": "select order_id, customer_id, product_id, sales from orders_clean",
    "dq_quarantine_bronze": f"select {_FEED}, {BRONZE_REASON} as _failure_reason from raw "
                            f"where {BRONZE_BAD}",
    "dq_quarantine_silver": f"""select order_id, customer_id, product_id, sales, quantity, discount,
  profit, {SILVER_REASON} as failure_reason, {SILVER_VIOLATIONS} as violations
from order_rows where not coalesce({ORDER_OK}, false)""",
    "dq_quarantine_silver_subset": f"""select order_id, customer_id, product_id, sales, quantity,
  discount, profit, order_date_raw, ship_date_raw, case when discount is null or discount < 0
  or discount > 0.5 then 'discount out of range [0.0, 0.5]' else 'profit IS NULL' end
  as failure_reason from bronze where {SILVER_SUBSET}""",
    "dq_split_is_partition": f"""select case when {BRONZE_BAD} then '{{bad}}' else '{{good}}' end
  as side, count(*) as n, count(order_id) as n_ids, {rnd(total('sales'), 2)} as sales
from raw group by all""".replace("{bad}", "rejected").replace("{good}", "accepted"),
    "dq_first_reason": f"select {BRONZE_REASON} as reason, count(*) as n from raw "
                       f"where {BRONZE_BAD} group by all",
    "dq_all_reasons": f"select order_id, product_id, sales, quantity, "
                      f"{BRONZE_VIOLATIONS} as violations from raw",
    "dq_report": "\nunion all\n".join([
        _report("bronze_raw_sales", "raw", _BRONZE_RULES),
        _report("silver_customers_clean", "customer_rows", _CUSTOMER_DROPS + _CUSTOMER_WARNS),
        _report("silver_products_clean", "product_rows", _PRODUCT_DROPS + _PRODUCT_WARNS),
        _report("silver_orders_clean", "order_rows", _ORDER_DROPS + _ORDER_WARNS),
        _report("gold_fact_sales", "orders_clean", _FACT_RULES)]),
    # deduplication and streams
    "dedup_customers": f"select {CUSTOMER_COLUMNS} from customers",
    "dedup_products": f"select {PRODUCT_COLUMNS} from products",
    "dedup_orders": "select order_id, customer_id, product_id, sales, quantity, discount, profit, "
                    "ship_date from orders_clean",
    "dedup_orders_before_rules": f"""select {ORDER_COLUMNS} from (
  select *, row_number() over (partition by order_id order by {FIRST_BY}) as rn from order_rows)
where rn = 1 and {ORDER_OK}""",
    "stream_dedup_global": f"select {CUSTOMER_COLUMNS} from customers",
    "stream_dedup_watermark": """select distinct order_id, customer_id from orders_ok
where l_linenumber <> 1
union all
select distinct order_id, customer_id from orders_ok where l_linenumber = 1
  and order_date > (select max(order_date) - interval 1000 day from orders_ok where l_linenumber <> 1)
  and order_id not in (select order_id from orders_ok where l_linenumber <> 1)""",
    "stream_dedup_within": """select order_id, customer_id, min(ship_date) as ship_date
from shipped where not second group by all
union all
select order_id, customer_id, min(ship_date) from shipped, shipped_mark
where second and ship_date > mark and order_id not in (
  select order_id from shipped where not second group by order_id
  having min(ship_date) > (select mark - interval 200 day from shipped_mark))
group by all""",
    "stream_late_rows": """select order_id, product_id, ship_date, sales from shipped, shipped_mark
where second and ship_date <= mark""",
    "stream_watermark": f"""select {instant("date_trunc('hour', ts)")} as hour, event_type,
  count(*) as n, {rnd(total('value'), 2)} as value from events
where date_trunc('hour', ts) + interval 1 hour
  <= (select max(ts) - interval 1 hour from events) group by all""",
    "stream_static_star_join": f"select {FACT_COLUMNS} from fact",
    # type-2 history
    "scd2_history": _HISTORY_OUT,
    "scd2_out_of_order": _HISTORY_OUT,
    "scd2_incremental_equals_full": _HISTORY_OUT,
    "scd2_tracked_columns": f"select user_id, event_type, value, {instant('start_ts')} as start_at, "
                            f"{instant('end_ts')} as end_at from history",
    "scd2_current": f"select user_id, event_type, {instant('start_ts')} as start_at "
                    "from history where end_ts is null",
    "scd2_customer": _scd("customer_rows", "customer_id", CUSTOMER_COLUMNS),
    "scd2_product": _scd("product_rows", "product_id", PRODUCT_COLUMNS),
    "scd2_as_of_join": f"""select e.event_id, e.user_id, {instant('e.ts')} as at,
  h.event_type as version_type, {instant('h.start_ts')} as start_at
from events e left join history h on e.user_id = h.user_id and h.start_ts <= e.ts
  and (h.end_ts is null or e.ts < h.end_ts)""",
    # joins
    "join_left_using": """select o.customer_id, o.order_id, o.sales, c.full_name, c.segment
from orders_clean o left join customers c using (customer_id)""",
    "join_left_expr": """select o.order_id, o.order_date, d.date_key, d.quarter_label
from orders_clean o left join spine d on o.order_date = d.full_date""",
    "fact_star_join": f"select {FACT_COLUMNS} from fact",
    "fact_unmatched_dims": f"""
with_placeholder
select 'gold_dim_customer' as dimension, count(full_name) as matched,
  count(*) - count(full_name) as unmatched from part_fact
union all
select 'gold_dim_product', count(product_name), count(*) - count(product_name) from part_fact
union all
select 'gold_dim_date', count(date_key), count(*) - count(date_key) from part_fact""",
    # aggregates and windows
    "agg_sum": f"""select order_year, {rnd(total('sales'), 2)} as total_sales,
  cast(sum(quantity) as bigint) as total_quantity from orders_ok group by all""",
    "agg_avg": f"""select order_year, {mean('discount', 4)} as avg_discount,
  {mean('sales', 2)} as avg_sales, {rnd('avg(shipping_days)', 1)} as avg_shipping_days
from orders_ok group by all""",
    "agg_count_distinct_multi": """select segment, count(distinct customer_id) as unique_customers,
  count(distinct order_id) as total_orders, count(distinct product_id) as unique_products
from orders_ok group by all""",
    "agg_ratio_of_sums": f"""select region,
  {rnd(f"({total('profit')} / {total('sales')})", 4)} as margin,
  {rnd(f"({total('profit')} / {total('sales')} * 100)", 2)} as margin_pct
from orders_ok group by all""",
    "agg_revenue_per_customer": f"""select segment,
  {rnd(f"({total('sales')} / count(distinct customer_id))", 2)} as revenue_per_customer
from orders_ok group by all""",
    "agg_conditional_share": f"""select region,
  {rnd("(count(*) filter (where ship_mode = 'Same Day') / count(*) * 100)", 1)} as pct_same_day,
  count(*) as n from orders_ok group by all""",
    "win_rank": """select product_id, sub_category, category_of_goods, total_sales,
  sales_rank_in_category from kpi_product""",
    "win_lag": """select year_month, region, category_of_goods, monthly_sales, prev_month_sales
from monthly_lag""",
    "win_mom_growth": """select year_month, region, category_of_goods, mom_growth_pct
from kpi_monthly_trend""",
    "win_mom_calendar": f"""select year_month, region, category_of_goods, monthly_sales,
  prev_month_sales, case when prev_month_sales > 0 then
  {rnd('((monthly_sales - prev_month_sales) / prev_month_sales * 100)', 2)} end as mom_growth_pct
from calendar_lag""",
    "sort_global": "select region, category_of_goods, order_year, total_sales "
                   "from kpi_region_category order by 1, 2, 3",
    "topk_per_category": "select product_id, sub_category, category_of_goods, total_sales, "
                         "sales_rank_in_category from kpi_product "
                         "where sales_rank_in_category <= 3",
    "kpi_region_category": "select * from kpi_region_category",
    "kpi_segment": "select * from kpi_segment",
    "kpi_product": "select * from kpi_product",
    "kpi_monthly_trend": "select * from kpi_monthly_trend",
    "kpi_outlet_city": "select * from kpi_outlet_city",
    # layers
    "layer_bronze": f"select {_FEED} from bronze",
    "layer_silver_customers": f"select {CUSTOMER_COLUMNS} from customers",
    "layer_silver_products": f"select {PRODUCT_COLUMNS} from products",
    "layer_silver_orders": f"select {ORDER_COLUMNS} from orders_clean",
}

# The star join with a customer dimension and a calendar that do not cover every order.
CTES["part_fact"] = star(_CUSTOMERS_BORN_BEFORE, "products", _SHORT_SPINE)
SELECTS["fact_unmatched_dims"] = SELECTS["fact_unmatched_dims"].replace("with_placeholder", "")


def oracle_sql() -> dict[str, str]:
    return {name: query(select) for name, select in SELECTS.items()}
