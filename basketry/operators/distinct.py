"""Exact numbers of distinct values of several columns in one grouping."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.session import staged


def distinct_counts(rows: DataFrame, keys: list[str], counted: dict[str, str]) -> DataFrame:
    """``keys`` with one number for each entry ``{result: column}`` of ``counted``; NULL values don't count.

    Several distinct counts in one aggregation make Spark copy each row once per column. Here the
    needed columns are stored once, each column is read with the keys alone and reduced to distinct
    pairs before its shuffle, and the counts, one row per group and column, are put side by side. NULL
    keys form groups, as in any grouping; an empty table gives an empty result.
    """
    held = staged(rows.select(*keys, *sorted(set(counted.values()) - set(keys))), "distinct-values")

    def count_of(result: str, column: str) -> DataFrame:
        # Under a name of its own, as a key may be counted too.
        pairs = held.select(*keys, F.col(column).alias("__value")).distinct()
        own = pairs.groupBy(*keys).agg(F.count("__value").alias("__count"))
        return own.select(*keys, *[(F.col("__count") if r == result else F.lit(0).cast("long")).alias(r) for r in counted])

    parts = reduce(DataFrame.unionAll, [count_of(*entry) for entry in counted.items()])
    return parts.groupBy(*keys).agg(*[F.max(r).alias(r) for r in counted])
