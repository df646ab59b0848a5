"""Parquet tables: whole-table refreshes, and batches of a stream written once each.

A stream that writes more than one table does so from ``foreachBatch``; every table then has one
folder per batch, and a batch that is run again after a failure replaces its own folder.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession, functions as F, types as T

from basketry.contracts import TableInfo

BATCH = "batch"
# Commits take turns in so many folders, so the last ones are never being replaced when they are read.
_TURNS = 4
_COMMIT = "_commit"


def balanced(df: DataFrame, columns: Sequence[str] = ()) -> DataFrame:
    """Even out the files of a write: adaptive execution merges small partitions and splits the
    large ones, so a year with a third of all rows is written by many tasks."""
    return df.hint("rebalance", *columns)


def commit(rows: DataFrame, path: str, number: int) -> None:
    """Make ``rows``, a small table, the newest commit at ``path``. A commit that is run again
    replaces itself, and one that fails leaves those before it."""
    rows.withColumn(_COMMIT, F.lit(number).cast("long")).coalesce(1).write.mode("overwrite").parquet(
        f"{path}/turn={number % _TURNS}")


def last_commit(
    spark: SparkSession, path: str, schema: T.StructType, most: int, before: int | None = None
) -> tuple[int, list[Row]]:
    """Number and rows of the newest commit, of ``most`` rows at most; -1 if there is none. With
    ``before``, the newest of those with a lower number."""
    named = T.StructType([*schema.fields, T.StructField(_COMMIT, T.LongType())])
    rows = spark.read.schema(named).option("ignoreMissingFiles", "true").parquet(path)
    if before is not None:
        rows = rows.filter(F.col(_COMMIT) < before)
    found = rows.orderBy(F.desc(_COMMIT)).limit(most).collect()
    number = found[0][_COMMIT] if found else -1
    return number, [row for row in found if row[_COMMIT] == number]


_SLOT = T.StructType([T.StructField("slot", T.IntegerType())])


def recompute(df: DataFrame, path: str) -> None:
    """Replace a table as a whole: write beside it, then switch by one committed row.

    Two slots take turns. A write that fails leaves the table as it was, and a reader that is busy
    with it keeps its files until the second write after.
    """
    spark, commits = df.sparkSession, f"{path}/commits"
    create(spark, commits, _SLOT)
    number, rows = last_commit(spark, commits, _SLOT, 1)
    slot = 1 - rows[0]["slot"] if rows else 0
    refresh(df, f"{path}/slot={slot}")
    commit(spark.range(1).select(F.lit(slot).alias("slot")), commits, number + 1)


def computed(spark: SparkSession, path: str) -> bool:
    """Whether a ``recompute`` of the table has finished."""
    commits = f"{path}/commits"
    return exists(spark, commits) and last_commit(spark, commits, _SLOT, 1)[0] >= 0


def recomputed(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """The table that the last finished ``recompute`` has left."""
    _, rows = last_commit(spark, f"{path}/commits", _SLOT, 1)
    if not rows:
        raise FileNotFoundError(f"{path} has not been computed yet")
    return snapshot(spark, f"{path}/slot={rows[0]['slot']}", schema)


def refresh(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Replace the table at ``path``, which ``df`` must not read.

    A partitioned table is rebalanced by its partition columns first, else every task would write
    a small file into every partition.
    """
    rows = balanced(df, partition_by) if partition_by else df
    rows.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def publish(df: DataFrame, name: str, path: str, info: TableInfo) -> None:
    """Write ``df`` to ``path`` as catalog table ``name`` with comment and layer tag."""
    rows = balanced(df, info.partition_by) if info.partition_by else df
    writer = rows.write.mode("overwrite").option("path", path).partitionBy(*info.partition_by)
    writer.saveAsTable(name)
    spark = df.sparkSession
    spark.sql(f"COMMENT ON TABLE {name} IS '{info.comment}'")
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('quality' = '{info.quality}')")


def exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.format("binaryFile").load(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True


def create(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """Make the folder of a table without rows, unless it is there.

    What is written has a name that Spark's readers skip, so it suits every partitioning.
    """
    spark.createDataFrame([], schema).coalesce(1).write.mode("ignore").parquet(f"{path}/_created")


def plain(columns: Sequence[str]) -> dict[str, str]:
    """Options of a Parquet write that makes no dictionaries of these columns. Where values hardly repeat, or
    are long, to look each up in its dictionary takes longer than to write and read it as it is."""
    return {f"parquet.enable.dictionary#{name}": "false" for name in columns}


def write_batch(
    df: DataFrame, path: str, batch_id: int, partition_by: Sequence[str] = (), **options: str
) -> None:
    """Write the folder of one batch, replacing what an earlier attempt left.

    The rows stay where they are: where a batch falls into one or two time partitions, tasks sized by
    the scan write files of a good size without a shuffle. Others are ``balanced`` first.
    """
    target = f"{path}/{BATCH}={batch_id}"
    df.write.mode("overwrite").options(**options).partitionBy(*partition_by).parquet(target)


def replace_folders(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Write the partitions that ``df`` has rows of, replacing each as a whole; others stay."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        *partition_by).parquet(path)


def snapshot(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Read a table as it is now. With ``schema``, text partition columns keep their type."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def batches(
    spark: SparkSession, path: str, schema: T.StructType, up_to: int | None = None
) -> DataFrame:
    """All batches of a table written with ``write_batch``, or those up to one of them."""
    rows = snapshot(spark, path, _with_batch(schema))
    if up_to is not None:
        rows = rows.filter(F.col(BATCH) <= up_to)
    return rows.drop(BATCH)


def one_batch(spark: SparkSession, path: str, schema: T.StructType, batch_id: int) -> DataFrame:
    """The rows of one batch; only its folder is read."""
    return snapshot(spark, path, _with_batch(schema)).filter(F.col(BATCH) == batch_id).drop(BATCH)


def changes(spark: SparkSession, path: str, schema: T.StructType, **options) -> DataFrame:
    """A stream of the rows added to a table."""
    return spark.readStream.schema(schema).options(**options).parquet(path)


def batch_changes(spark: SparkSession, path: str, schema: T.StructType, **options) -> DataFrame:
    """A stream of the rows added to a table written with ``write_batch``."""
    return changes(spark, path, _with_batch(schema), **options).drop(BATCH)


def _with_batch(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(BATCH, T.LongType())])
