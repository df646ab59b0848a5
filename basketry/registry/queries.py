"""The registered queries: each takes (spark, folder of test tables) and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from basketry import contracts as C
from basketry.functions import dates, measures as M, text
from basketry.operators import calendar, quality as Q, scd2, star
from basketry.operators.distinct import distinct_counts
from basketry.plans import bronze, gold, kpi, rules as R, silver
from basketry.session import scratch_folder, staged
from basketry.sources import sales_csv, tables
from basketry.sources.testtables import FIRST_BY, INGESTED, TIEBREAK_EXTRA, raw_sales
from basketry.sources.testtables import raw_slices, raw_with_audit, table
from basketry.streaming import cleansing, ingest, runs
from basketry.streaming.arrivals import FirstInTime
from basketry.streaming.firsts import FirstSeen
from basketry.streaming.history import History

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Fixed value: the date that stands for today in the registered queries.
AS_OF = "1990-01-01"
# A calendar that ends before the last orders, to show unmatched days.
SHORT_SPINE = ("2015-01-01", "2019-12-31")
# Landed files: one task reads a compressed file, so their rows are limited. At this level zlib packs the feed
# to about a fifth; its default level takes twice the time for a tenth less.
FILE_ROWS, PACKED = 500_000, {"compression": "gzip", "zlib.compress.level": "FOUR"}


def registered(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def _instant(name: str, alias: str):
    return F.date_format(name, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(alias)


# -- inputs shared by the queries --------------------------------------------------------------
def _raw(spark, sf_dir):
    return raw_with_audit(spark, sf_dir)


def _bronze(spark, sf_dir):
    return bronze.accepted(_raw(spark, sf_dir))


def _stored_bronze(spark, sf_dir):
    """Bronze as a table, for queries that read it several times: the joins behind the feed then
    run once."""
    return staged(_bronze(spark, sf_dir), "bronze")


def _kept_orders(base):
    return silver.with_order_period(Q.keep(silver.order_rows(base), R.ORDER_RULES))


def _orders_ok(spark, sf_dir):
    return _kept_orders(_bronze(spark, sf_dir))


def _orders(spark, sf_dir):
    return silver.orders(_bronze(spark, sf_dir), FIRST_BY, TIEBREAK_EXTRA)


def _current_customers(base, as_of=None):
    return gold.current_customers(gold.customer_feed(base, as_of))


def _current_products(base):
    return gold.current_products(gold.product_feed(base))


def _fact(spark, sf_dir, as_of=None, spine=C.SPINE_BOUNDS):
    base = _stored_bronze(spark, sf_dir)
    return gold.fact_sales(
        spark, silver.orders(base, FIRST_BY, TIEBREAK_EXTRA), _current_customers(base, as_of),
        _current_products(base), spine,
    )


def _order_days(spark, sf_dir):
    later = F.col("o_orderdate") + F.expr("interval '20' year")
    return table(spark, sf_dir, "orders").select("o_orderkey", later.cast("date").alias("d"))


def _events(spark, sf_dir):
    return table(spark, sf_dir, "events")


def _history(spark, sf_dir, track=None):
    columns = ["user_id", "event_type"] if track is None else ["user_id", "event_type", "value"]
    return scd2.versions(_events(spark, sf_dir), ["user_id"], "ts", columns, track)


def _history_out(history):
    return history.select(
        "user_id", "event_type", _instant(C.START_AT, "start_at"), _instant(C.END_AT, "end_at")
    )


# -- sources and sinks -------------------------------------------------------------------------
def _with_headers(rows: DataFrame) -> DataFrame:
    return rows.select(*[F.col(name).alias(header) for header, _, name in C.RAW_FIELDS])


def _flagged():
    return F.coalesce(F.col("l_returnflag") == "R", F.lit(False))


def _write_csv(rows: DataFrame, folder: str, **options: str) -> None:
    """Add ``rows`` to the files of a folder, compressed unless ``options`` say otherwise: as plain text the
    feed takes 13 times the room of its tables."""
    named = {"header": True, "maxRecordsPerFile": FILE_ROWS, **PACKED, **options}
    rows.write.mode("append").options(**named).csv(folder)


def _landing(spark, sf_dir) -> str:
    """The feed as CSV files in two folders that differ in the order of their columns."""
    folder = scratch_folder(spark, "landing")
    for rows in raw_slices(spark, sf_dir):
        _write_csv(_with_headers(rows.filter(~_flagged())), f"{folder}/first")
        moved = _with_headers(rows.filter(_flagged()))
        _write_csv(moved.select(*reversed(moved.columns)), f"{folder}/second")
    return folder


def _ingested(spark, sf_dir, triggers=None, passes=1) -> DataFrame:
    """Accepted and rejected rows of a triggered ingestion, put together again."""
    landing, root = _landing(spark, sf_dir), scratch_folder(spark, "tables")
    max_files = C.MAX_FILES_PER_TRIGGER
    if triggers:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(landing)
        max_files = -(-files.select("path").count() // triggers)
    for _ in range(passes):
        ingest.ingest(
            spark, landing, root, f"{root}/_checkpoints/ingest", max_files,
            F.lit(INGESTED).cast("timestamp"),
        )
    good = tables.batches(spark, f"{root}/{C.BRONZE_SALES}", ingest.bronze_schema())
    bad = tables.batches(spark, f"{root}/{C.BRONZE_QUARANTINE}", ingest.quarantine_schema())
    return (
        good.select(*C.FEED_COLUMNS, F.lit("accepted").alias("side"))
        .unionByName(bad.select(*C.FEED_COLUMNS, F.lit("rejected").alias("side")))
    )


def _loaded(spark, landing) -> DataFrame:
    """The rows of all CSV files under ``landing``, read in triggers of bounded size."""
    target = scratch_folder(spark, "loaded")
    ingest.load(spark, landing, f"{target}/table", f"{target}/_checkpoints")
    return tables.batches(spark, f"{target}/table", sales_csv.feed_with_lineage_schema())


@registered
def src_csv_incremental(spark, sf_dir):
    """Files that arrive between two runs, the second lot compressed; a third run finds nothing new.

    The first lot is plain text, so it has the order lines of about one supplier in 16; the second has the others.
    """
    landing, root = scratch_folder(spark, "landing"), scratch_folder(spark, "tables")
    early = F.pmod(F.xxhash64("l_suppkey"), F.lit(16)) == 0
    for part, codec, slices in ((early, "none", 1), (~early, "gzip", 2), (None, None, 0)):
        for rows in raw_slices(spark, sf_dir, slices):
            _write_csv(_with_headers(rows.filter(part)), f"{landing}/{codec}", compression=codec)
        ingest.ingest(
            spark, landing, root, f"{root}/_checkpoints/ingest",
            ingested_at=F.lit(INGESTED).cast("timestamp"),
        )
    good = tables.batches(spark, f"{root}/{C.BRONZE_SALES}", ingest.bronze_schema())
    bad = tables.batches(spark, f"{root}/{C.BRONZE_QUARANTINE}", ingest.quarantine_schema())
    return good.select(*C.FEED_COLUMNS).unionByName(bad.select(*C.FEED_COLUMNS))


@registered
def src_csv_header_by_name(spark, sf_dir):
    return _loaded(spark, _landing(spark, sf_dir)).select(*C.FEED_COLUMNS)


@registered
def src_explicit_schema(spark, sf_dir):
    rows = _loaded(spark, _landing(spark, sf_dir))
    return rows.select(
        "order_id", "year", "postal_code", "quantity", "sales", "discount", "profit"
    )


@registered
def src_rescued_data(spark, sf_dir):
    """Quantities with a unit and a column the feed does not know end up in the rescue column."""
    folder = scratch_folder(spark, "rescue")
    many = F.concat(F.col("quantity").cast("string"), F.lit(" pcs"))
    quantity = F.when(F.col("quantity") > 40, many).otherwise(F.col("quantity").cast("string"))
    titled = [F.col(n).alias(h) for h, _, n in C.RAW_FIELDS if n != "quantity"]
    for rows in raw_slices(spark, sf_dir, 2):
        _write_csv(rows.select(F.col("l_returnflag").alias("Return Flag"), *titled,
                               quantity.alias("Quantity")), folder)
    return _loaded(spark, folder).select(
        "order_id", "customer_id", "product_id", "quantity",
        F.get_json_object(C.RESCUED, "$.Quantity").alias("rescued_quantity"),
        F.get_json_object(C.RESCUED, "$['Return Flag']").alias("rescued_flag"),
    )


@registered
def src_max_files_per_trigger(spark, sf_dir):
    """The files come in four portions."""
    return _ingested(spark, sf_dir, triggers=4).drop("side")


@registered
def src_trigger_available_now(spark, sf_dir):
    return _ingested(spark, sf_dir).drop("side")


@registered
def src_file_metadata(spark, sf_dir):
    rows = _loaded(spark, _landing(spark, sf_dir))
    files = rows.groupBy(C.SOURCE_FILE).agg(  # so that folders are looked for in files, not in rows
        F.count(F.lit(1)).alias("n"), F.bool_and(F.col(C.FILE_MODIFIED).isNotNull()).alias("time_is_set")
    )
    return files.groupBy(F.regexp_extract(C.SOURCE_FILE, "/([^/]*)/[^/]*$", 1).alias("folder")).agg(
        F.sum("n").alias("n"), F.bool_and("time_is_set").alias("time_is_set")
    )


@registered
def src_audit_columns(spark, sf_dir):
    rows = bronze.with_audit(raw_sales(spark, sf_dir), F.lit(INGESTED).cast("timestamp"))
    return rows.select(
        "order_id",
        F.date_format(C.INGESTED_AT, "yyyy-MM-dd HH:mm:ss").alias("ingested_at"),
        C.INGEST_YEAR, C.INGEST_MONTH,
    )


@registered
def sink_partitioned_append(spark, sf_dir):
    """Orders appended by a stream to a table partitioned by year; read back and totalled."""
    rows = _orders_ok(spark, sf_dir).select("order_id", "sales", "order_year")
    source, target = scratch_folder(spark, "orders"), scratch_folder(spark, "appended")
    tables.refresh(rows, source)
    stream = tables.changes(spark, source, rows.schema)
    runs.append(stream, f"{target}/_checkpoints", f"{target}/table", ["order_year"])
    stored = tables.batches(spark, f"{target}/table", rows.schema)
    return stored.groupBy("order_year").agg(
        F.count(F.lit(1)).alias("n"), M.total("sales").alias("sales")
    )


@registered
def sink_recompute(spark, sf_dir):
    """A table computed twice holds one result, that of the second time."""
    target, kpis = scratch_folder(spark, "recomputed"), kpi_region_category(spark, sf_dir)
    tables.recompute(kpis.withColumn("total_sales", F.lit(0.0)), target)
    tables.recompute(kpis, target)
    return tables.recomputed(spark, target)


# -- projections, filters, scalar expressions --------------------------------------------------
@registered
def proj_rename_columns(spark, sf_dir):
    return bronze.renamed(_with_headers(raw_sales(spark, sf_dir)))


@registered
def proj_select_alias(spark, sf_dir):
    return raw_sales(spark, sf_dir).select(
        F.col("order_id").alias("id"), F.col("product_id").alias("item"),
        F.col("sales").alias("amount"),
    )


@registered
def proj_derived(spark, sf_dir):
    day = dates.parsed_day("sales_date_raw")
    return raw_sales(spark, sf_dir).select("order_id", "sales_date_raw").withColumns(
        {"sales_year": dates.text_year(day), "sales_month": dates.text_month(day)}
    )


@registered
def scalar_cast(spark, sf_dir):
    return raw_sales(spark, sf_dir).select(
        "order_id",
        F.col("quantity").cast("double").alias("quantity_double"),
        F.col("year").cast("string").alias("year_text"),
        F.col("order_date_raw").try_cast("date").alias("day"),
    )


@registered
def scalar_trim(spark, sf_dir):
    padded = raw_sales(spark, sf_dir).select(
        "order_id",
        F.concat(F.lit(" "), "product_name", F.lit("  ")).alias("product_name"),
        F.concat(F.lit("  "), "segment").alias("segment"),
    )
    return padded.select("order_id", text.trimmed("product_name"), text.trimmed("segment"))


@registered
def scalar_trim_upper(spark, sf_dir):
    return raw_sales(spark, sf_dir).select("customer_id", text.trimmed_upper("segment"))


@registered
def scalar_concat_ws(spark, sf_dir):
    rows = raw_sales(spark, sf_dir).withColumn(
        "last_name", F.when(F.col("l_returnflag") != "R", F.col("last_name"))
    )
    return rows.select("customer_id", text.joined("first_name", "last_name").alias("full_name"))


@registered
def date_quarter_label(spark, sf_dir):
    return _order_days(spark, sf_dir).select(
        "o_orderkey", dates.quarter_label("d").alias("quarter_label")
    )


@registered
def pred_not_blank(spark, sf_dir):
    return raw_sales(spark, sf_dir).select("order_id", "customer_id").filter(text.filled("order_id"))


@registered
def scalar_parse_date(spark, sf_dir):
    return raw_sales(spark, sf_dir).select(
        "order_id",
        dates.parsed_day("order_date_raw").alias("order_date"),
        dates.parsed_day("ship_date_raw").alias("ship_date"),
    )


@registered
def scalar_datediff(spark, sf_dir):
    first, last = dates.parsed_day("order_date_raw"), dates.parsed_day("ship_date_raw")
    return raw_sales(spark, sf_dir).select(
        "order_id", dates.days_between(first, last).alias("shipping_days")
    )


@registered
def date_parts(spark, sf_dir):
    return _order_days(spark, sf_dir).select(
        "o_orderkey", F.year("d").alias("year"), F.quarter("d").alias("quarter"),
        F.month("d").alias("month"), F.weekofyear("d").alias("week_of_year"),
        F.dayofmonth("d").alias("day_of_month"), F.dayofweek("d").alias("day_of_week"),
    )


@registered
def date_format_patterns(spark, sf_dir):
    patterns = {
        "date_key": "yyyyMMdd", "month_name": "MMMM", "month_short": "MMM",
        "day_name": "EEEE", "day_short": "EEE", "year_month": "yyyy-MM",
    }
    return _order_days(spark, sf_dir).select(
        "o_orderkey", *[F.date_format("d", p).alias(n) for n, p in patterns.items()]
    )


@registered
def date_weekend_flags(spark, sf_dir):
    return _order_days(spark, sf_dir).select(
        "o_orderkey", dates.is_weekend("d").alias("is_weekend"),
        (~dates.is_weekend("d")).alias("is_weekday"),
    )


@registered
def date_spine(spark, sf_dir):
    """The calendar with the number of orders of each day."""
    per_day = _order_days(spark, sf_dir).groupBy("d").agg(F.count(F.lit(1)).alias("n"))
    days = calendar.date_spine(spark)
    return days.join(per_day, days.full_date == per_day.d, "left").select(
        *days.columns, F.coalesce("n", F.lit(0)).alias("n_orders")
    )


@registered
def scalar_round(spark, sf_dir):
    return raw_sales(spark, sf_dir).select(
        "order_id", F.round(F.col("sales") / 7, 1).alias("r1"),
        F.round(F.col("sales") / 7, 2).alias("r2"), F.round(F.col("discount") / 7, 4).alias("r4"),
    )


@registered
def scalar_net_sales(spark, sf_dir):
    return raw_sales(spark, sf_dir).select("order_id", M.net_amount().alias("net_sales"))


@registered
def scalar_margin_guarded(spark, sf_dir):
    return raw_sales(spark, sf_dir).select(
        "order_id", M.guarded_ratio("profit", "sales").alias("profit_margin_pct"),
        M.guarded_ratio("sales", "profit").alias("sales_per_profit"),
    )


@registered
def case_first_reason(spark, sf_dir):
    reason = Q.first_reason(R.BRONZE_REASONS, R.BRONZE_OTHER)
    return raw_sales(spark, sf_dir).select("order_id", "quantity", reason.alias("reason"))


@registered
def filter_compound_null(spark, sf_dir):
    return raw_sales(spark, sf_dir).select("order_id", "sales", "quantity", "profit").filter(
        (F.col("order_id").isNull() | F.col("profit").isNull()) & (F.col("quantity") > 10)
    )


@registered
def pred_range(spark, sf_dir):
    return raw_sales(spark, sf_dir).select("order_id", "quantity", "discount").filter(
        F.col("quantity").between(*C.QUANTITY_RANGE) & F.col("discount").between(*C.DISCOUNT_RANGE)
    )


@registered
def pred_in_list(spark, sf_dir):
    return raw_sales(spark, sf_dir).select("order_id", "ship_mode", "city_type").filter(
        F.col("ship_mode").isin("Same Day", "First Class")
        & F.col("city_type").isin("Tier 1", "Tier 2")
    )


@registered
def pred_valid_dob(spark, sf_dir):
    rule = next(r for r in R.customer_rules(AS_OF) if r.name == "valid_dob")
    return raw_sales(spark, sf_dir).select(
        "customer_id", dates.parsed_day("date_of_birth_raw").alias("dob")
    ).filter(rule.holds())


# -- data quality ------------------------------------------------------------------------------
@registered
def dq_drop_bronze(spark, sf_dir):
    return _bronze(spark, sf_dir).select("order_id", "product_id", "sales", "quantity")


@registered
def dq_drop_customers(spark, sf_dir):
    feed = gold.customer_feed(_bronze(spark, sf_dir), AS_OF)
    return feed.select("customer_id", "first_name", "dob")


@registered
def dq_drop_products(spark, sf_dir):
    feed = gold.product_feed(_bronze(spark, sf_dir))
    return feed.select("product_id", "product_name", "category_of_goods")


@registered
def dq_drop_orders(spark, sf_dir):
    return _orders_ok(spark, sf_dir).select(
        "order_id", "customer_id", "product_id", "sales", "quantity", "discount", "profit",
        "order_date", "ship_date",
    )


@registered
def dq_warn_metrics(spark, sf_dir):
    base = _stored_bronze(spark, sf_dir)
    warn = lambda rules: Q.having(rules, Q.WARN)
    reports = [
        Q.report(silver.customer_rows(base), warn(R.customer_rules(AS_OF)), C.SILVER_CUSTOMERS),
        Q.report(silver.product_rows(base), warn(R.PRODUCT_RULES), C.SILVER_PRODUCTS),
        Q.report(silver.order_rows(base), warn(R.ORDER_RULES), C.SILVER_ORDERS),
    ]
    return reduce(DataFrame.unionByName, reports)


@registered
def dq_fail_passes_clean(spark, sf_dir):
    checked = Q.abort_on_violation(_orders(spark, sf_dir), R.FACT_RULES)
    return checked.select("order_id", "customer_id", "product_id", "sales")


@registered
def dq_quarantine_bronze(spark, sf_dir):
    bad = bronze.quarantine(bronze.tagged(_raw(spark, sf_dir)))
    return bad.select(*C.FEED_COLUMNS, "_failure_reason")


@registered
def dq_quarantine_silver(spark, sf_dir):
    return silver.quarantine(_bronze(spark, sf_dir)).select(
        "order_id", "customer_id", "product_id", "sales", "quantity", "discount", "profit",
        "failure_reason", F.concat_ws("|", Q.VIOLATIONS).alias("violations"),
    )


@registered
def dq_quarantine_silver_subset(spark, sf_dir):
    bad = silver.quarantine(_bronze(spark, sf_dir), complete=False)
    return bad.drop(C.SOURCE_FILE, C.INGESTED_AT)


@registered
def dq_split_is_partition(spark, sf_dir):
    return _ingested(spark, sf_dir).groupBy("side").agg(
        F.count(F.lit(1)).alias("n"), F.count("order_id").alias("n_ids"),
        M.total("sales").alias("sales"),
    )


@registered
def dq_first_reason(spark, sf_dir):
    bad = bronze.quarantine(bronze.tagged(_raw(spark, sf_dir)))
    return bad.groupBy(F.col("_failure_reason").alias("reason")).agg(F.count(F.lit(1)).alias("n"))


@registered
def dq_all_reasons(spark, sf_dir):
    return bronze.tagged(_raw(spark, sf_dir)).select(
        "order_id", "product_id", "sales", "quantity",
        F.concat_ws("|", Q.VIOLATIONS).alias("violations"),
    )


@registered
def dq_report(spark, sf_dir):
    raw = staged(_raw(spark, sf_dir), "raw")
    base = bronze.accepted(raw)
    reports = [
        Q.report(raw, R.BRONZE_RULES, C.BRONZE_SALES),
        Q.report(silver.customer_rows(base), R.customer_rules(AS_OF), C.SILVER_CUSTOMERS),
        Q.report(silver.product_rows(base), R.PRODUCT_RULES, C.SILVER_PRODUCTS),
        Q.report(silver.order_rows(base), R.ORDER_RULES, C.SILVER_ORDERS),
        Q.report(silver.orders(base, FIRST_BY, TIEBREAK_EXTRA), R.FACT_RULES, C.FACT_SALES),
    ]
    return reduce(DataFrame.unionByName, reports)


# -- deduplication and streams -----------------------------------------------------------------
@registered
def dedup_customers(spark, sf_dir):
    return silver.customers(_bronze(spark, sf_dir)).drop(*silver.AUDIT)


@registered
def dedup_products(spark, sf_dir):
    return silver.products(_bronze(spark, sf_dir)).drop(*silver.AUDIT)


@registered
def dedup_orders(spark, sf_dir):
    return _orders(spark, sf_dir).select(
        "order_id", "customer_id", "product_id", "sales", "quantity", "discount", "profit",
        "ship_date",
    )


@registered
def dedup_orders_before_rules(spark, sf_dir):
    """One row per order is chosen first and checked afterwards."""
    orders = silver.orders(_bronze(spark, sf_dir), FIRST_BY, TIEBREAK_EXTRA, dedup_first=True)
    return orders.drop(C.SOURCE_FILE, C.INGESTED_AT)


def _streamed(spark, rows: DataFrame, transform, label: str) -> DataFrame:
    """Store ``rows``, run ``transform`` over them as a stream, and read what it stored."""
    source, target = scratch_folder(spark, f"{label}-in"), scratch_folder(spark, label)
    tables.refresh(rows, source)
    stream = transform(tables.changes(spark, source, rows.schema, maxFilesPerTrigger="1000"))
    runs.append(stream, f"{target}/_checkpoints", f"{target}/table")
    return tables.batches(spark, f"{target}/table", stream.schema)


@registered
def stream_dedup_global(spark, sf_dir):
    """Customers that arrive in two batches; each is kept as first seen."""
    bronze_rows = _stored_bronze(spark, sf_dir)
    source, target = scratch_folder(spark, "customers-in"), scratch_folder(spark, "customers")
    schema = silver.customer_rows(bronze_rows.limit(0)).schema
    seen = FirstSeen(f"{target}/table", gold.CUSTOMER_KEY, silver.AUDIT, schema)
    early = F.coalesce(F.col("l_linenumber") <= 2, F.lit(True))
    for part in (early, ~early):
        bronze_rows.filter(part).write.mode("append").parquet(source)
        stream = tables.changes(spark, source, bronze_rows.schema)
        runs.drain(cleansing.customer_rows(stream), f"{target}/_checkpoints", seen.add)
    return tables.batches(spark, f"{target}/table", schema).drop(*silver.AUDIT)


@registered
def stream_dedup_watermark(spark, sf_dir):
    """Orders in two batches by the date of the order. Those of the second that are more than 1,000 days
    behind the first are dropped, even if they were never seen."""
    rows = _timed(spark, sf_dir, "order_date_raw")
    source, target = scratch_folder(spark, "orders-in"), scratch_folder(spark, "orders-global")
    second = F.coalesce(F.col("l_linenumber") == 1, F.lit(False))
    for part in (~second, second):
        rows.filter(part).write.mode("append").parquet(source)
        stream = cleansing.orders(tables.changes(spark, source, rows.schema), horizon="1000 days")
        runs.append(stream, f"{target}/_checkpoints", f"{target}/table")
    return tables.batches(spark, f"{target}/table", stream.schema).select("order_id", "customer_id")


def _timed(spark, sf_dir, day: str) -> DataFrame:
    """Bronze rows whose event time is one of their days."""
    return _stored_bronze(spark, sf_dir).withColumn(C.INGESTED_AT, dates.parsed_day(day).cast("timestamp"))


def _shipped(spark, sf_dir) -> FirstInTime:
    """Orders by the day they were shipped, remembered for 200 days, in two batches: the second has what
    was shipped since July 2018, and the third lines of all orders, some of them late."""
    rows = _timed(spark, sf_dir, "ship_date_raw")
    source, target = scratch_folder(spark, "shipped-in"), scratch_folder(spark, "shipped")
    orders = FirstInTime(
        f"{target}/table", f"{target}/late", f"{target}/marks", ["order_id"], C.INGESTED_AT, "200 days",
        [C.SOURCE_FILE], silver.order_rows(rows).schema)
    orders.create(spark)
    second = F.coalesce((F.col(C.INGESTED_AT) >= "2018-07-01") | (F.col("l_linenumber") == 3), F.lit(False))
    for part in (~second, second):
        rows.filter(part).write.mode("append").parquet(source)
        stream = cleansing.order_rows(tables.changes(spark, source, rows.schema))
        runs.drain(stream, f"{target}/_checkpoints", orders.add)
    return orders


@registered
def stream_dedup_within(spark, sf_dir):
    """An order that is shipped again after the horizon is let in again."""
    return _shipped(spark, sf_dir).read(spark).select("order_id", "customer_id", "ship_date")


@registered
def stream_late_rows(spark, sf_dir):
    """Rows behind the watermark, every one of them."""
    return _shipped(spark, sf_dir).late(spark).select("order_id", "product_id", "ship_date", "sales")


@registered
def stream_watermark(spark, sf_dir):
    """Hourly totals per event type, emitted once the watermark, one hour behind, has passed."""

    def hourly(events):
        return (
            events.withColumn("ts", F.col("ts").cast("timestamp"))
            .withWatermark("ts", "1 hour")
            .groupBy(F.window("ts", "1 hour"), "event_type")
            .agg(F.count(F.lit(1)).alias("n"), M.total("value").alias("value"))
            .select(_instant("window.start", "hour"), "event_type", "n", "value")
        )

    return _streamed(spark, _events(spark, sf_dir), hourly, "hourly")


@registered
def stream_static_star_join(spark, sf_dir):
    base = _stored_bronze(spark, sf_dir)
    customers, products = _current_customers(base), _current_products(base)

    def joined(orders):
        return gold.fact_sales(spark, orders, customers, products)

    orders = silver.orders(base, FIRST_BY, TIEBREAK_EXTRA)
    fact = _streamed(spark, orders, joined, "fact")
    return fact.drop(C.SOURCE_FILE, C.INGESTED_AT)


# -- type-2 history ----------------------------------------------------------------------------
@registered
def scd2_history(spark, sf_dir):
    return _history_out(_history(spark, sf_dir))


@registered
def scd2_out_of_order(spark, sf_dir):
    """The same history from changes that arrive in another order."""
    events = _events(spark, sf_dir)
    late = F.col("value") >= 50
    arrived = events.filter(late).unionByName(events.filter(~F.coalesce(late, F.lit(False))))
    return _history_out(scd2.versions(arrived, ["user_id"], "ts", ["user_id", "event_type"]))


@registered
def scd2_tracked_columns(spark, sf_dir):
    """``value`` is stored with each version but opens none."""
    history = _history(spark, sf_dir, track=["event_type"])
    return history.select(
        "user_id", "event_type", "value",
        _instant(C.START_AT, "start_at"), _instant(C.END_AT, "end_at"),
    )


@registered
def scd2_current(spark, sf_dir):
    return scd2.current(_history(spark, sf_dir)).select(
        "user_id", "event_type", _instant(C.START_AT, "start_at")
    )


def _dated(rows_of, base: DataFrame) -> DataFrame:
    """Cleansed feed rows with the order date as their sequence."""
    parsed = base.withColumn(C.INGESTED_AT, dates.parsed_day("order_date_raw"))
    return rows_of(parsed)


@registered
def scd2_customer(spark, sf_dir):
    return gold.dim_customer(_dated(gold.customer_feed, _stored_bronze(spark, sf_dir)))


@registered
def scd2_product(spark, sf_dir):
    return gold.dim_product(_dated(gold.product_feed, _stored_bronze(spark, sf_dir)))


@registered
def scd2_as_of_join(spark, sf_dir):
    facts = _events(spark, sf_dir).select("event_id", "user_id", "ts")
    versions = _history(spark, sf_dir).withColumnRenamed("event_type", "version_type")
    joined = scd2.as_of_join(facts, versions, ["user_id"], "ts", ["version_type"])
    return joined.select(
        "event_id", "user_id", _instant("ts", "at"), "version_type",
        _instant(C.START_AT, "start_at"),
    )


@registered
def scd2_incremental_equals_full(spark, sf_dir):
    """Two batches whose times interleave, added one after the other."""
    events = _events(spark, sf_dir).select("user_id", "event_type", "ts", "value")
    source, target = scratch_folder(spark, "changes"), scratch_folder(spark, "history")
    history = History(
        f"{target}/table", ["user_id"], "ts", ["user_id", "event_type"], events.schema
    )
    history.create(spark)
    late = F.coalesce(F.col("value") >= 50, F.lit(False))
    for part in (events.filter(~late), events.filter(late)):
        part.write.mode("append").parquet(source)
        stream = tables.changes(spark, source, events.schema)
        runs.drain(stream, f"{target}/_checkpoints", history.upsert)
    return _history_out(history.read(spark))


# -- joins -------------------------------------------------------------------------------------
@registered
def join_left_using(spark, sf_dir):
    base = _stored_bronze(spark, sf_dir)
    orders = silver.orders(base, FIRST_BY, TIEBREAK_EXTRA).select("order_id", "customer_id", "sales")
    customers = _current_customers(base).select("customer_id", "full_name", "segment")
    return orders.join(customers, on="customer_id", how="left")


@registered
def join_left_expr(spark, sf_dir):
    orders = _orders(spark, sf_dir)
    days = F.broadcast(calendar.date_spine(spark))
    return orders.join(days, orders.order_date == days.full_date, "left").select(
        "order_id", "order_date", "date_key", "quarter_label"
    )


@registered
def fact_star_join(spark, sf_dir):
    return _fact(spark, sf_dir).drop(C.SOURCE_FILE, C.INGESTED_AT)


@registered
def fact_unmatched_dims(spark, sf_dir):
    return star.unmatched(_fact(spark, sf_dir, AS_OF, SHORT_SPINE))


# -- aggregates, windows, order ----------------------------------------------------------------
@registered
def agg_sum(spark, sf_dir):
    return _orders_ok(spark, sf_dir).groupBy("order_year").agg(
        M.total("sales").alias("total_sales"), F.sum("quantity").alias("total_quantity")
    )


@registered
def agg_avg(spark, sf_dir):
    return _orders_ok(spark, sf_dir).groupBy("order_year").agg(
        M.mean("discount", 4).alias("avg_discount"), M.mean("sales", 2).alias("avg_sales"),
        F.round(F.avg("shipping_days"), 1).alias("avg_shipping_days"),
    )


@registered
def agg_count_distinct_multi(spark, sf_dir):
    return distinct_counts(_orders_ok(spark, sf_dir), ["segment"], {
        "unique_customers": "customer_id", "total_orders": "order_id", "unique_products": "product_id"})


@registered
def agg_ratio_of_sums(spark, sf_dir):
    return _orders_ok(spark, sf_dir).groupBy("region").agg(
        M.ratio_of_sums("profit", "sales", 4).alias("margin"),
        M.ratio_of_sums("profit", "sales", 2, times=100).alias("margin_pct"),
    )


@registered
def agg_revenue_per_customer(spark, sf_dir):
    return _orders_ok(spark, sf_dir).groupBy("segment").agg(
        M.sum_per("sales", F.count_distinct("customer_id")).alias("revenue_per_customer")
    )


@registered
def agg_conditional_share(spark, sf_dir):
    return _orders_ok(spark, sf_dir).groupBy("region").agg(
        M.share_percent(F.col("ship_mode") == "Same Day").alias("pct_same_day"),
        F.count(F.lit(1)).alias("n"),
    )


_PRODUCT_RANK = [
    "product_id", "sub_category", "category_of_goods", "total_sales", "sales_rank_in_category",
]
_MONTH_KEYS = ["year_month", "region", "category_of_goods"]


@registered
def win_rank(spark, sf_dir):
    return kpi.by_product(_fact(spark, sf_dir), True).select(*_PRODUCT_RANK)


@registered
def win_lag(spark, sf_dir):
    trend = kpi.monthly_trend(_fact(spark, sf_dir), True)
    return trend.select(*_MONTH_KEYS, "monthly_sales", "prev_month_sales")


@registered
def win_mom_growth(spark, sf_dir):
    return kpi.monthly_trend(_fact(spark, sf_dir), True).select(*_MONTH_KEYS, "mom_growth_pct")


@registered
def win_mom_calendar(spark, sf_dir):
    trend = kpi.monthly_trend(_fact(spark, sf_dir), True, calendar_months=True)
    return trend.select(*_MONTH_KEYS, "monthly_sales", "prev_month_sales", "mom_growth_pct")


@registered
def sort_global(spark, sf_dir):
    order = kpi.PRESENTATION_ORDER[C.KPI_REGION_CATEGORY]
    return kpi_region_category(spark, sf_dir).select(*order, "total_sales").orderBy(*order)


@registered
def topk_per_category(spark, sf_dir):
    return kpi.top_products(_fact(spark, sf_dir), 3, True).select(*_PRODUCT_RANK)


@registered
def kpi_region_category(spark, sf_dir):
    return kpi.by_region_category(_fact(spark, sf_dir), True)


@registered
def kpi_segment(spark, sf_dir):
    return kpi.by_customer_segment(_fact(spark, sf_dir), True)


@registered
def kpi_product(spark, sf_dir):
    return kpi.by_product(_fact(spark, sf_dir), True)


@registered
def kpi_monthly_trend(spark, sf_dir):
    return kpi.monthly_trend(_fact(spark, sf_dir), True)


@registered
def kpi_outlet_city(spark, sf_dir):
    return kpi.by_outlet_city(_fact(spark, sf_dir), True)


# -- layers ------------------------------------------------------------------------------------
@registered
def layer_bronze(spark, sf_dir):
    return _bronze(spark, sf_dir).select(*C.FEED_COLUMNS)


@registered
def layer_silver_customers(spark, sf_dir):
    return silver.customers(_bronze(spark, sf_dir)).drop(*silver.AUDIT)


@registered
def layer_silver_products(spark, sf_dir):
    return silver.products(_bronze(spark, sf_dir)).drop(*silver.AUDIT)


@registered
def layer_silver_orders(spark, sf_dir):
    return _orders(spark, sf_dir).drop(C.SOURCE_FILE, C.INGESTED_AT)
