"""Type-2 history from a change feed.

A feed row says: from ``sequence_by`` on, this key has these attributes. A version is a maximal run
of rows, in sequence order, whose tracked attributes are equal; it is valid in the half-open interval
[``__START_AT``, ``__END_AT``), with ``__END_AT`` NULL for the current one. The history is a function
of the set of feed rows, so the order of arrival does not matter and late rows split the interval
they fall into.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from basketry.contracts import END_AT, FILE_MODIFIED, INGESTED_AT, SOURCE_FILE, START_AT
from basketry.operators import hotkeys as H
from basketry.operators.dedup import latest_per_key
from basketry.session import ROWS_PER_TASK, staged

AUDIT_COLUMNS = (SOURCE_FILE, INGESTED_AT, FILE_MODIFIED)
# Of rows with the same key and sequence, those of the later file count.
LATER_FILE = (FILE_MODIFIED, SOURCE_FILE)


def tracked_columns(keys: Sequence[str], columns: Sequence[str]) -> list[str]:
    """Default for ``track``: every stored column but the keys and the audit columns, so that a
    re-delivered, unchanged row opens no version."""
    return [c for c in columns if c not in keys and c not in AUDIT_COLUMNS]


def present(log: DataFrame, tiebreak: Sequence[str]) -> list[str]:
    return [c for c in tiebreak if c in log.columns]


def observations(
    log: DataFrame,
    keys: Sequence[str],
    sequence_by: str,
    columns: Sequence[str],
    tiebreak: Sequence[str] = LATER_FILE,
) -> DataFrame:
    """One row per key and sequence value; rows without a key or a sequence are left out.

    Of rows that tie, the last by ``tiebreak`` counts (columns the log lacks are passed over), then
    the greatest by all stored columns. The choice is made before the shuffle as well, so a feed
    that repeats a key many times per sequence shrinks first.
    """
    ties = present(log, tiebreak)
    wanted = list(dict.fromkeys([*keys, *columns, sequence_by, *ties]))
    rows = log.select(*wanted).dropna(subset=[*keys, sequence_by])
    return latest_per_key(rows, [*keys, sequence_by], [c for c in ties if c != sequence_by])


def versions(
    log: DataFrame,
    keys: Sequence[str],
    sequence_by: str,
    columns: Sequence[str],
    track: Sequence[str] | None = None,
    rows_per_task: int = ROWS_PER_TASK,
    max_slices: int = H.MAX_SLICES,
) -> DataFrame:
    """All versions of all keys: ``columns`` plus ``__START_AT`` and ``__END_AT``."""
    keys = list(keys)
    track = list(track) if track is not None else tracked_columns(keys, columns)
    state = F.struct(*track)

    known = log.dropna(subset=[*keys, sequence_by])
    points = H.split_points(known, keys, sequence_by, rows_per_task, max_slices)
    rows = H.sliced(
        observations(log, keys, sequence_by, columns), keys, sequence_by, points, max_slices
    )
    in_slice = Window.partitionBy(*keys, H.SLICE).orderBy(sequence_by)
    over_slices = H.across_slices(keys)

    # The row before: within the slice, else the last row of the slice before.
    tails = (
        H.hot_only(rows)
        .groupBy(*keys, H.SLICE)
        .agg(F.max_by(state, F.col(sequence_by)).alias("_tail"))
    )
    rows = rows.withColumn("_before", F.lag(state).over(in_slice))
    rows = H.add_from_slices(rows, keys, tails, "_carried", F.lag("_tail").over(over_slices))
    before = F.coalesce("_before", "_carried")
    kept = rows.filter(~state.eqNullSafe(before))

    # The change after: within the slice, else the first change of the next slice that has one.
    heads = H.hot_only(kept).groupBy(*keys, H.SLICE).agg(F.min(sequence_by).alias("_head"))
    kept = kept.withColumn("_after", F.lead(sequence_by).over(in_slice))
    kept = H.add_from_slices(kept, keys, heads, "_next", F.lead("_head").over(over_slices))
    return kept.select(
        *columns,
        F.col(sequence_by).alias(START_AT),
        F.coalesce("_after", "_next").alias(END_AT),
    )


def current(history: DataFrame) -> DataFrame:
    return history.filter(F.col(END_AT).isNull())


def latest_state(
    log: DataFrame, keys: Sequence[str], sequence_by: str, columns: Sequence[str]
) -> DataFrame:
    """Attributes of each key's last feed row: the tracked columns of ``current(versions(...))``
    without building the history. At most one row per key and map task is shuffled."""
    ties = [c for c in present(log, LATER_FILE) if c != sequence_by]
    rows = log.select(*dict.fromkeys([*keys, *columns, sequence_by, *ties]))
    rows = rows.dropna(subset=[*keys, sequence_by])
    return latest_per_key(rows, keys, [sequence_by, *ties]).select(*columns)


def as_of_join(
    facts: DataFrame,
    history: DataFrame,
    keys: Sequence[str],
    at: str,
    attributes: Sequence[str],
    rows_per_task: int = ROWS_PER_TASK,
    max_slices: int = H.MAX_SLICES,
) -> DataFrame:
    """Each fact with ``attributes`` of the version valid at its time ``at``; NULLs if there is none.

    The times at which a key has facts are merged with its versions in time order, and the last
    version is carried forward. That costs a sort, where an equality join with a range condition would
    compare every fact of a key with every version of it. Each key and time is looked up once,
    however many facts it has; facts get the answer by an equality join, which splits hot keys.
    The merged rows are stored first, so the history is worked out once.
    """
    keys = list(keys)
    names = [*attributes, START_AT, END_AT]
    fact_rows = facts.select(*keys, F.col(at).alias("_at"), F.lit(1).alias("_kind")).distinct()
    version_rows = history.select(
        *keys,
        F.col(START_AT).alias("_at"),
        F.lit(0).alias("_kind"),
        F.struct(*names).alias("_version"),
    )
    merged = staged(fact_rows.unionByName(version_rows, allowMissingColumns=True), "as-of")
    points = H.split_points(merged, keys, "_at", rows_per_task, max_slices)
    rows = H.sliced(merged, keys, "_at", points, max_slices)

    so_far = (
        Window.partitionBy(*keys, H.SLICE)
        .orderBy("_at", "_kind")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    tails = (
        H.hot_only(rows)
        .groupBy(*keys, H.SLICE)
        .agg(F.max_by("_version", F.when(F.col("_kind") == 0, F.col("_at"))).alias("_tail"))
    )
    earlier = H.across_slices(keys).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_seen", F.last("_version", ignorenulls=True).over(so_far))
    rows = H.add_from_slices(
        rows, keys, tails, "_carried", F.last("_tail", ignorenulls=True).over(earlier)
    )
    found = F.coalesce("_seen", "_carried")
    valid = found[END_AT].isNull() | (F.col("_at") < found[END_AT])
    answers = rows.filter((F.col("_kind") == 1) & F.when(valid, found).isNotNull()).select(
        *keys, F.col("_at").alias(at), found.alias("_found"))
    joined = H.match_null_safe(facts, answers, [*keys, at])
    return joined.select(*facts.columns, *[F.col("_found")[n].alias(n) for n in names])
