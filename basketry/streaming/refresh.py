"""One triggered run over all layers.

The steps run one after the other because each reads what the one before has stored. A second run on
the same root takes up only what is new; a run on a new root is a full refresh.
"""

from __future__ import annotations

from dataclasses import dataclass

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from basketry import contracts as C
from basketry.operators import quality as Q
from basketry.operators.calendar import date_spine, days_in
from basketry.operators.scd2 import current
from basketry.operators.star import star_join
from basketry.plans import gold, kpi, rules as R, silver
from basketry.sources import tables
from basketry.streaming import cleansing, ingest
from basketry.streaming.arrivals import FirstInTime
from basketry.streaming.firsts import FirstSeen
from basketry.streaming.history import BUCKETS, History
from basketry.streaming.runs import drain, finish, start_append, start_batches


_REPORT = T.StructType([
    T.StructField("table_name", T.StringType()), T.StructField("rule_name", T.StringType()),
    T.StructField("action", T.StringType()), T.StructField("passed", T.LongType()),
    T.StructField("failed", T.LongType()),
])


@dataclass(frozen=True)
class Lakehouse:
    """Where the tables are and how a run behaves."""

    landing: str
    root: str
    spine: tuple[str, str] = C.SPINE_BOUNDS
    order_mode: str = cleansing.GLOBAL
    horizon: str = C.LATE_HORIZON
    max_files: int = C.MAX_FILES_PER_TRIGGER
    first_seen_dimensions: bool = False
    order_salts: int = 1
    dimension_buckets: int = BUCKETS
    #: Bytes of a table that one trigger takes up, in every stream of a run.
    max_bytes: int = C.MAX_BYTES_PER_TRIGGER

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def checkpoint(self, table: str) -> str:
        return f"{self.root}/_checkpoints/{table}"

    # -- reading -----------------------------------------------------------------------------
    def bronze_changes(self, spark: SparkSession) -> DataFrame:
        return self._changes(spark, C.BRONZE_SALES, ingest.bronze_schema())

    def _changes(self, spark: SparkSession, table: str, schema: T.StructType) -> DataFrame:
        """What is new in a stored table, in triggers of bounded size: a backlog becomes several batches."""
        return tables.batch_changes(spark, self.path(table), schema, maxBytesPerTrigger=self.max_bytes)

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        if table == C.BRONZE_SALES:
            return tables.batches(spark, self.path(table), ingest.bronze_schema())
        if table == C.BRONZE_QUARANTINE:
            return tables.batches(spark, self.path(table), ingest.quarantine_schema())
        if table == C.RULE_REPORT:
            return self._report(spark)
        if table in (C.DIM_CUSTOMER, C.DIM_PRODUCT):
            return self.history(spark, table).read(spark)
        stored = self.stored_schema(spark, table)
        if stored is not None:
            return tables.batches(spark, self.path(table), stored)
        rows = tables.recomputed(spark, self.path(table))
        return rows.orderBy(*kpi.PRESENTATION_ORDER[table]) if table in kpi.PRESENTATION_ORDER else rows

    def stored_schema(self, spark: SparkSession, table: str) -> T.StructType | None:
        """Schema of the silver tables and the fact. Text partition columns make it necessary: Spark
        would read them as numbers."""
        empty = spark.createDataFrame([], ingest.bronze_schema())
        if table == C.SILVER_CUSTOMERS:
            return silver.customer_rows(empty).schema
        if table == C.SILVER_PRODUCTS:
            return silver.product_rows(empty).schema
        if table in (C.SILVER_ORDERS, C.LATE_ORDERS):
            return silver.with_order_period(silver.order_rows(empty)).schema
        if table == C.SILVER_QUARANTINE:
            return silver.quarantine(empty).schema
        if table == C.FACT_SALES:
            return self._fact(spark, self._no_orders(spark)).schema
        return None

    def history(self, spark: SparkSession, table: str) -> History:
        empty = spark.createDataFrame([], ingest.bronze_schema())
        if table == C.DIM_CUSTOMER:
            feed, keys, columns = gold.customer_feed(empty), gold.CUSTOMER_KEY, C.DIM_CUSTOMER_COLUMNS
        else:
            feed, keys, columns = gold.product_feed(empty), gold.PRODUCT_KEY, C.DIM_PRODUCT_COLUMNS
        return History(self.path(table), keys, C.INGESTED_AT, columns, feed.schema,
                       buckets=self.dimension_buckets)

    def _report(self, spark: SparkSession) -> DataFrame:
        """Rows that kept and that broke each rule, over all batches."""
        parts = [tables.batches(spark, f"{self.path(C.RULE_REPORT)}/{part}", _REPORT) for part in ("bronze", "silver")]
        return reduce(DataFrame.unionByName, parts).groupBy("table_name", "rule_name", "action").agg(
            F.sum("passed").alias("passed"), F.sum("failed").alias("failed"))

    def orders_in_time(self, spark: SparkSession) -> FirstInTime:
        """The orders of the mode ``within``, and those that came too late."""
        return FirstInTime(
            self.path(C.SILVER_ORDERS), self.path(C.LATE_ORDERS), f"{self.root}/_marks/{C.SILVER_ORDERS}",
            ["order_id"], C.INGESTED_AT, self.horizon, [C.SOURCE_FILE], self.stored_schema(spark, C.SILVER_ORDERS),
            C.TABLES[C.SILVER_ORDERS].partition_by)

    # -- running -----------------------------------------------------------------------------
    def run(self, spark: SparkSession, ingested_at: Column | None = None) -> None:
        """Bring every table up to date with the landing folder, which may be empty."""
        self.prepare(spark)
        self.run_bronze(spark, ingested_at)
        self.run_silver(spark)
        self.run_report(spark)
        self.run_dimensions(spark)
        self.run_fact(spark)
        self.run_kpis(spark)

    def prepare(self, spark: SparkSession) -> None:
        """Make the tables that do not exist yet, without rows, so that every step finds its input even
        before the first row has come as far."""
        empty_ones = {
            C.BRONZE_SALES: ingest.bronze_schema(),
            C.BRONZE_QUARANTINE: ingest.quarantine_schema(),
            C.SILVER_CUSTOMERS: self.stored_schema(spark, C.SILVER_CUSTOMERS),
            C.SILVER_PRODUCTS: self.stored_schema(spark, C.SILVER_PRODUCTS),
            C.SILVER_ORDERS: self.stored_schema(spark, C.SILVER_ORDERS),
            C.SILVER_QUARANTINE: self.stored_schema(spark, C.SILVER_QUARANTINE),
        }
        for name, schema in empty_ones.items():
            tables.create(spark, self.path(name), schema)
        for part in ("bronze", "silver"):
            tables.create(spark, f"{self.path(C.RULE_REPORT)}/{part}", _REPORT)
        if self.order_mode == cleansing.WITHIN:
            self.orders_in_time(spark).create(spark)
        for name in (C.DIM_CUSTOMER, C.DIM_PRODUCT):
            self.history(spark, name).create(spark)
        if not tables.computed(spark, self.path(C.DIM_DATE)):
            tables.recompute(date_spine(spark, *self.spine), self.path(C.DIM_DATE))
        # The schema of the fact comes from the dimensions, so they are made before it.
        tables.create(spark, self.path(C.FACT_SALES), self.stored_schema(spark, C.FACT_SALES))

    def run_bronze(self, spark: SparkSession, ingested_at: Column | None = None) -> None:
        ingest.ingest(
            spark, self.landing, self.root, self.checkpoint(C.BRONZE_SALES), self.max_files,
            ingested_at,
        )

    def run_silver(self, spark: SparkSession) -> None:
        bronze = self.bronze_changes(spark)
        kept = {
            C.SILVER_CUSTOMERS: (cleansing.customer_rows(bronze), gold.CUSTOMER_KEY),
            C.SILVER_PRODUCTS: (cleansing.product_rows(bronze), gold.PRODUCT_KEY),
        }
        queries = [
            start_batches(
                rows, self.checkpoint(name),
                FirstSeen(self.path(name), keys, silver.AUDIT, rows.schema).add,
            )
            for name, (rows, keys) in kept.items()
        ]
        appended = {C.SILVER_QUARANTINE: silver.quarantine(bronze)}
        if self.order_mode == cleansing.WITHIN:
            rows = silver.with_order_period(cleansing.order_rows(bronze))
            queries.append(start_batches(
                rows, self.checkpoint(C.SILVER_ORDERS), self.orders_in_time(spark).add))
        else:
            appended[C.SILVER_ORDERS] = cleansing.orders(bronze, self.order_mode, self.horizon, self.order_salts)
        queries += [
            start_append(rows, self.checkpoint(name), self.path(name), C.TABLES[name].partition_by)
            for name, rows in appended.items()
        ]
        finish(queries)

    def run_report(self, spark: SparkSession) -> None:
        """Count what the rules of the silver tables say of the new rows. The bronze rules are counted as
        their rows are split; a broken fail rule stops the run."""

        def each_batch(rows: DataFrame, batch_id: int) -> None:
            counts = reduce(DataFrame.unionByName, [
                Q.report(silver.customer_rows(rows), R.customer_rules(), C.SILVER_CUSTOMERS),
                Q.report(silver.product_rows(rows), R.PRODUCT_RULES, C.SILVER_PRODUCTS),
                Q.report(silver.order_rows(rows), R.ORDER_RULES, C.SILVER_ORDERS),
            ])
            tables.write_batch(counts.coalesce(1), f"{self.path(C.RULE_REPORT)}/silver", batch_id)

        drain(self.bronze_changes(spark), self.checkpoint(C.RULE_REPORT), each_batch)

    def run_dimensions(self, spark: SparkSession) -> None:
        if self.first_seen_dimensions:
            feeds = {
                C.DIM_CUSTOMER: self._silver_changes(spark, C.SILVER_CUSTOMERS),
                C.DIM_PRODUCT: self._silver_changes(spark, C.SILVER_PRODUCTS),
            }
        else:
            bronze = self.bronze_changes(spark)
            feeds = {
                C.DIM_CUSTOMER: gold.customer_feed(bronze),
                C.DIM_PRODUCT: gold.product_feed(bronze),
            }
        finish(
            start_batches(feed, self.checkpoint(name), self.history(spark, name).upsert)
            for name, feed in feeds.items()
        )
        tables.recompute(date_spine(spark, *self.spine), self.path(C.DIM_DATE))

    def _silver_changes(self, spark: SparkSession, table: str) -> DataFrame:
        return self._changes(spark, table, self.stored_schema(spark, table))

    def _no_orders(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([], self.stored_schema(spark, C.SILVER_ORDERS))

    def _fact(self, spark: SparkSession, orders: DataFrame) -> DataFrame:
        joined = star_join(
            orders,
            current(self.read(spark, C.DIM_CUSTOMER)),
            current(self.read(spark, C.DIM_PRODUCT)),
            self.read(spark, C.DIM_DATE),
            days_in(*self.spine),
        )
        return Q.abort_on_violation(joined, R.FACT_RULES)

    def run_fact(self, spark: SparkSession) -> None:
        """Append the new orders, each batch joined with the dimensions as they are when it comes."""
        path, by = self.path(C.FACT_SALES), C.TABLES[C.FACT_SALES].partition_by

        def each_batch(orders: DataFrame, batch_id: int) -> None:
            fact = self._fact(orders.sparkSession, orders)
            tables.write_batch(tables.balanced(fact, by), path, batch_id, by)

        drain(self._silver_changes(spark, C.SILVER_ORDERS), self.checkpoint(C.FACT_SALES), each_batch)

    def run_kpis(self, spark: SparkSession) -> None:
        fact = self.read(spark, C.FACT_SALES)
        unique = self.order_mode == cleansing.GLOBAL
        for name, build in kpi.KPI_TABLES.items():
            table = kpi.stamped(build(fact, unique))
            tables.recompute(table, self.path(name))
