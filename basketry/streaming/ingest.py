"""Landing folder to the bronze table and its quarantine."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from basketry import contracts as C
from basketry.operators import quality as Q
from basketry.plans import bronze, rules as R
from basketry.sources import sales_csv, tables
from basketry.streaming.runs import drain

# The rows of a batch until both sides are written.
_COPY = "_batch"
# Whether a row of that copy keeps all rules.
_KEPT = "_kept"
# How rows of the feed are stored: in three fifths of the room that Parquet's default takes.
_STORED = {"compression": "zstd", **tables.plain(C.VARIED_COLUMNS)}


def write_split(
    rows: DataFrame,
    batch_id: int,
    good_path: str,
    bad_path: str,
    quarantine,
    partition_by: Sequence[str] = (),
    report_path: str | None = None,
) -> None:
    """Write both sides of a quality split, and a report of its rules, from one evaluation of the batch.

    The batch is stored beside its rejected rows, under a name that readers skip, and read back for each
    side. Unlike a cached frame it takes no memory of the executors, outlives them, and is read by tasks
    sized by its compressed columns, so that the sides have files of a good size without a shuffle.
    It says of each row whether it is kept; which rules a row breaks is told for the rejected ones only.
    """
    spark, copy = rows.sparkSession, f"{bad_path}/{_COPY}"
    judged = rows.withColumn(_KEPT, Q.all_hold(Q.having(R.BRONZE_RULES, Q.DROP)))
    judged.write.mode("overwrite").options(**_STORED).parquet(copy)
    stored = spark.read.schema(judged.schema).parquet(copy)
    good, bad = (stored.filter(side).drop(_KEPT) for side in (F.col(_KEPT), ~F.col(_KEPT)))
    tables.write_batch(good, good_path, batch_id, partition_by, **_STORED)
    tables.write_batch(quarantine(bronze.tagged(bad)), bad_path, batch_id, **_STORED)
    if report_path:
        tables.write_batch(Q.report(stored, R.BRONZE_RULES, C.BRONZE_SALES), report_path, batch_id)
    spark.createDataFrame([], judged.schema).coalesce(1).write.mode("overwrite").parquet(copy)


def load(
    spark: SparkSession,
    landing: str,
    path: str,
    checkpoint: str,
    max_files: int = C.MAX_FILES_PER_TRIGGER,
    **csv_options: str,
) -> StreamingQuery:
    """Store the rows of the files that are new in ``landing``, typed, unchecked, with lineage.

    However many files there are, the driver handles the names and headers of one trigger at a time.
    """

    def each_batch(found: DataFrame, batch_id: int) -> None:
        paths = [row.path for row in found.collect()]
        rows = sales_csv.read_files(found.sparkSession, paths, **csv_options)
        tables.write_batch(rows, path, batch_id, **_STORED)

    return drain(sales_csv.discovered(spark, landing, max_files), checkpoint, each_batch)


def ingest(
    spark: SparkSession,
    landing: str,
    root: str,
    checkpoint: str,
    max_files: int = C.MAX_FILES_PER_TRIGGER,
    ingested_at: Column | None = None,
    **csv_options: str,
) -> StreamingQuery:
    """Read the files that are new in ``landing`` and split them by the bronze rules.

    Rejected rows come from the same reading as the accepted ones, so together they are the input.
    """

    def each_batch(found: DataFrame, batch_id: int) -> None:
        session = found.sparkSession
        paths = [row.path for row in found.collect()]
        rows = sales_csv.read_files(session, paths, **csv_options)
        write_split(
            bronze.with_audit(rows, ingested_at),
            batch_id,
            f"{root}/{C.BRONZE_SALES}",
            f"{root}/{C.BRONZE_QUARANTINE}",
            bronze.quarantine,
            C.TABLES[C.BRONZE_SALES].partition_by,
            f"{root}/{C.RULE_REPORT}/bronze",
        )

    return drain(sales_csv.discovered(spark, landing, max_files), checkpoint, each_batch)


def bronze_schema() -> T.StructType:
    schema = sales_csv.feed_with_lineage_schema()
    return schema.add(C.INGESTED_AT, "timestamp").add(C.INGEST_YEAR, "string").add(
        C.INGEST_MONTH, "string"
    )


def quarantine_schema() -> T.StructType:
    feed = C.feed_schema().add(C.RESCUED, "string").add(C.SOURCE_FILE, "string")
    return feed.add(C.INGESTED_AT, "timestamp").add(
        Q.VIOLATIONS, T.ArrayType(T.StringType())
    ).add("_failure_reason", "string")
