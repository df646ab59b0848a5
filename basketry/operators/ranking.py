"""Ranks within a group, for groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from basketry.operators import hotkeys as H
from basketry.session import ROWS_PER_TASK


def rank_in_group(
    df: DataFrame,
    group: Sequence[str],
    value: str,
    name: str,
    rows_per_task: int = ROWS_PER_TASK,
    max_slices: int = H.MAX_SLICES,
) -> DataFrame:
    """``rank()`` by descending ``value``: ties share a rank and leave a gap.

    Ranks count within a slice; for a group that had to be cut, the rows of the slices above are
    added. ``df`` is read once to count the groups and once to rank, so pass a stored table.
    """
    points = H.split_points(df, group, value, rows_per_task, max_slices)
    rows = H.sliced(df, group, value, points, max_slices)
    local = Window.partitionBy(*group, H.SLICE).orderBy(F.desc(value))
    ranked = rows.withColumn(name, F.rank().over(local))
    sizes = H.hot_only(rows).groupBy(*group, H.SLICE).agg(F.count(F.lit(1)).alias("_n"))
    above = Window.partitionBy(*group).orderBy(F.desc(H.SLICE)).rowsBetween(
        Window.unboundedPreceding, -1
    )
    ranked = H.add_from_slices(ranked, group, sizes, "_ahead", F.sum("_n").over(above))
    total = F.col(name) + F.coalesce(F.col("_ahead"), F.lit(0))
    return ranked.withColumn(name, total.cast("int")).select(*df.columns, name)


def top_in_group(df: DataFrame, group: Sequence[str], value: str, name: str, k: int) -> DataFrame:
    """Rows of rank ``k`` or better. Catalyst limits each group before the shuffle."""
    window = Window.partitionBy(*group).orderBy(F.desc(value))
    return df.withColumn(name, F.rank().over(window)).filter(F.col(name) <= k)
