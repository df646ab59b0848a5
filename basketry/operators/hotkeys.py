"""Splitting of hot keys for ordered windows.

A window over one key runs in one task. If a key may hold a third of all rows, that task is the whole
job. The helpers here cut the rows of such a key into consecutive slices of its order column, so
that a window over (key, slice) stays within ``rows_per_task`` rows. What a window needs from beyond
its slice (the row before, the row after, the number of rows ahead) is worked out once per slice and
joined back; per key that is at most ``max_slices`` rows.

Keys below the limit stay whole in slice 0. When no key is above it, adaptive execution sees the
empty broadcast and drops the extra joins; what remains is one count by key over the key column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from basketry.session import ROWS_PER_TASK

SLICE = "_slice"
SPLITS = "_splits"
MAX_SLICES = 1024


def match_null_safe(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left"
) -> DataFrame:
    """Join on equal keys where NULL equals NULL; the right side's keys are dropped."""
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    on = [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys]
    return left.join(renamed, on, how).drop(*[f"_right_{k}" for k in keys])


def split_points(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    rows_per_task: int = ROWS_PER_TASK,
    max_slices: int = MAX_SLICES,
) -> DataFrame:
    """Ascending split points of ``order`` for every key with more than ``rows_per_task`` rows.

    Both passes combine before their shuffle. For N rows the result has at most N / rows_per_task
    keys and twice as many points in all, which is what makes it safe to broadcast. ``order`` must be a
    number, a date or a time: text has no quantiles.
    """
    if isinstance(df.schema[order].dataType, T.StringType):
        raise ValueError(f"{order} is text; give the order as a number, a date or a time")
    hot = (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n") > rows_per_task)
    )
    fractions = ", ".join(f"{i / max_slices}D" for i in range(1, max_slices))
    points = (
        match_null_safe(df.select(*keys, order), F.broadcast(hot), keys, "inner")
        .groupBy(*keys)
        .agg(
            F.max("_n").alias("_n"),
            F.expr(f"percentile_approx(`{order}`, array({fractions}), {8 * max_slices})").alias(
                "_p"
            ),
        )
    )
    wanted = F.least(F.ceil(F.col("_n") / rows_per_task), F.lit(max_slices))
    return points.withColumn("_m", wanted.cast("int")).select(
        *keys,
        F.array_distinct(
            F.transform(
                F.sequence(F.lit(1), F.col("_m") - 1),
                lambda i: F.element_at("_p", F.floor(i * max_slices / F.col("_m")).cast("int")),
            )
        ).alias(SPLITS),
    )


def _points_below(value: Column, points: Column, max_slices: int) -> Column:
    """Number of ascending ``points`` below ``value``, by binary search."""
    steps, step = [], 1
    while step <= max_slices:
        steps.insert(0, step)
        step *= 2
    return F.aggregate(
        F.array(*[F.lit(s) for s in steps]),
        F.lit(0),
        lambda at, s: F.when(F.get(points, at + s - 1) < value, at + s).otherwise(at),
    )


def sliced(
    df: DataFrame, keys: Sequence[str], order: str, points: DataFrame, max_slices: int = MAX_SLICES
) -> DataFrame:
    """Add the slice of each row; ``_splits`` stays NULL for keys that are not hot.

    The slice depends on the value only, so equal values never part, and it ascends with the value,
    NULL being lowest.
    """
    joined = match_null_safe(df, F.broadcast(points), keys)
    below = _points_below(F.col(order), F.col(SPLITS), max_slices)
    return joined.withColumn(SLICE, F.when(F.col(SPLITS).isNotNull(), below).otherwise(F.lit(0)))


def hot_only(sliced_df: DataFrame) -> DataFrame:
    return sliced_df.filter(F.col(SPLITS).isNotNull())


def add_from_slices(
    sliced_df: DataFrame,
    keys: Sequence[str],
    summary: DataFrame,
    name: str,
    over_slices: Column,
) -> DataFrame:
    """Add ``name``, computed by a window over the slice summaries of each hot key.

    ``summary`` has one row per hot key and slice; ``over_slices`` is evaluated over it and is NULL
    for keys that are not hot.
    """
    per_slice = summary.select(*keys, SLICE, over_slices.alias(name))
    return match_null_safe(sliced_df, F.broadcast(per_slice), [*keys, SLICE])


def across_slices(keys: Sequence[str]):
    return Window.partitionBy(*keys).orderBy(SLICE)
