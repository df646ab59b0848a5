"""Raw rows to the bronze table and its quarantine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from basketry import contracts as C
from basketry.operators import quality as Q
from basketry.plans import rules as R


def renamed(raw: DataFrame) -> DataFrame:
    """The 25 headers of the feed to column names, in one projection."""
    return raw.withColumnsRenamed(C.RENAMES)


def with_audit(rows: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    """Add when the row came in, with year and month as text partition columns.

    ``ingested_at`` defaults to the clock; pass a value to repeat a run exactly.
    """
    at = F.current_timestamp() if ingested_at is None else ingested_at
    return rows.withColumns(
        {
            C.INGESTED_AT: at,
            C.INGEST_YEAR: F.year(at).cast("string"),
            C.INGEST_MONTH: F.month(at).cast("string"),
        }
    )


def accepted(rows: DataFrame) -> DataFrame:
    return Q.keep(rows, R.BRONZE_RULES)


def tagged(rows: DataFrame) -> DataFrame:
    return Q.tagged(rows, R.BRONZE_RULES)


def quarantine(tagged_rows: DataFrame) -> DataFrame:
    """Rejected rows with their first reason; all violated rules stay in ``_violations``."""
    reason = Q.first_reason(R.BRONZE_REASONS, R.BRONZE_OTHER)
    bad = Q.rejected(tagged_rows).withColumn("_failure_reason", reason)
    return bad.drop(C.INGEST_YEAR, C.INGEST_MONTH, C.FILE_MODIFIED)
