"""Helpers the operators of this package share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.session import scratch_folder, staged

#: White space between words: space and the control characters 9 to 13.
SPACES = r"[\x20\x09-\x0D]+"

#: Size of the membership filters below: a mebibyte of bits, whatever the input.
FILTER_BITS = 1 << 23


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words_in(text: Column) -> Column:
    """Number of words; NULL has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def slice_count(rows: int, per_slice: int) -> int:
    """Number of random slices of about ``per_slice`` rows, without a limit.

    Sums over slices pass one task, a few numbers per slice: ten million for twenty billion documents.
    """
    return max(1, -(-rows // per_slice))


def dealt_by_hash(rows: DataFrame, name: str, slices: int, per_slice: int) -> DataFrame:
    """Adds ``name``: the slice of each row by its hash ``spread``, or, where more rows than a slice should hold
    share one, by its number ``row``. ``rows`` is a staged table.

    Such hashes are at most one in ``per_slice`` of the rows; they are broadcast up to a million.
    """
    hot = staged(rows.groupBy("spread").count().filter(F.col("count") > per_slice)
                 .select("spread", F.lit(True).alias("__hot")), "hot")
    found, by = hot.count(), F.col("spread")
    if found:
        rows = rows.join(F.broadcast(hot) if found <= 1_000_000 else hot, "spread", "left")
        by = F.when(F.col("__hot"), F.xxhash64("row")).otherwise(by)
    return rows.withColumn(name, F.pmod(by, F.lit(slices))).drop("__hot")


def maybe_in(rows: DataFrame, keys: DataFrame, *columns: str) -> DataFrame:
    """``rows`` without most of those whose ``columns`` are not in ``keys``, before they are shuffled.

    The keys' hashes are gathered in a bit set of fixed size, at most ``FILTER_BITS`` / 64 rows, which
    is broadcast. It holds every key, and others by chance: the more keys, the fewer rows are
    skipped. So only an exact join behind it decides.
    """
    bit = F.pmod(F.xxhash64(*columns), F.lit(FILTER_BITS))
    bits = (
        keys.select(bit.alias("__bit"))
        .groupBy((F.col("__bit") / 64).cast("int").alias("__word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(__bit % 64 as int))")).alias("__bits"))
    )
    return (
        rows.withColumn("__bit", bit).withColumn("__word", (F.col("__bit") / 64).cast("int"))
        .join(F.broadcast(bits), "__word")
        .filter(F.getbit("__bits", (F.col("__bit") % 64).cast("int")) == 1)
        .drop("__bit", "__word", "__bits")
    )


def split_join(rows: DataFrame, summary: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join of ``rows`` with a summary that was grouped by the same keys and has one row for each.

    The grouping has dealt the summary by its keys, and Spark would keep that layout for the join. Then
    only one side has a shuffle of the join's own, and a key with very many rows cannot be split at run
    time. A hash of the keys as a further key makes both sides shuffle anew, and skewed keys split.
    """
    mark = F.xxhash64(*keys)
    return rows.withColumn("__mark", mark).join(
        summary.withColumn("__mark", mark), ["__mark", *keys], how).drop("__mark")


def staying(rows: DataFrame, decisions: DataFrame, id_key: Column, text_key: Column) -> DataFrame:
    """``rows`` without those that ``decisions`` (doc_id, text_key, stays), one for each row, drop.

    Of rows that agree in id and text, as many stay as the decisions say: all, none or one.
    """
    dropped = (
        decisions.groupBy("doc_id", "text_key")
        .agg(F.count_if("stays").alias("__stay"), F.count(F.lit(1)).alias("__rows"))
        .filter("__stay < __rows")
        .select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__text"), "__stay")
    )
    marked = rows.withColumn("__own_id", id_key).withColumn("__own_text", text_key).join(
        dropped, F.col("__own_id").eqNullSafe(F.col("__id")) & (F.col("__own_text") == F.col("__text")), "left")
    repeated = marked.filter("__stay > 0").dropDuplicates(["__own_id", "__own_text"])
    return marked.filter("__stay is null").select(rows.columns).unionByName(repeated.select(rows.columns))


__all__ = ["FILTER_BITS", "SPACES", "dealt_by_hash", "maybe_in", "scratch_folder", "slice_count", "split_join", "staged",
           "staying", "table", "words_in"]
