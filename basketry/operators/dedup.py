"""One row per key, on batches and on streams.

Batch: ``row_number() = 1`` under a total order. Catalyst turns this into a group limit that runs
before the shuffle, so each map task sends at most one row per key and a key that holds a third of
all rows costs its reducer one row per map task. Ordering by every column makes the choice the same
for every partitioning.

Stream: ``dropDuplicates`` keeps the first row seen, with one state row per key. Its shuffle has no
map-side reduction, so a hot key sends all of its rows to one task. Where one key may hold a large
share of a trigger, ``salts`` adds a first pass keyed by (key, salt), which spreads them and lets at
most one row per salt through; it doubles shuffle and state of all other keys, so it is off by default.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

_RANK = "_row_in_key"
_SALT = "_salt"


def _one_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    if not order:
        return df.dropDuplicates(list(keys))
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RANK, F.row_number().over(window)).filter(F.col(_RANK) == 1).drop(_RANK)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The earliest row of each key; NULLs in ``order`` come last, ties go by all columns."""
    rest = [c for c in df.columns if c not in order and c not in keys]
    return _one_per_key(df, keys, [F.asc_nulls_last(c) for c in [*order, *rest]])


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of each key; NULLs in ``order`` lose, ties go by all columns."""
    rest = [c for c in df.columns if c not in order and c not in keys]
    return _one_per_key(df, keys, [F.desc_nulls_last(c) for c in [*order, *rest]])


def _salt(salts: int) -> Column:
    # Which salt a row gets does not affect the result, only the load.
    return F.pmod(F.floor(F.rand() * salts).cast("int"), F.lit(salts))


def stream_first_seen(df: DataFrame, keys: Sequence[str], salts: int = 1) -> DataFrame:
    """First row seen per key, over the whole life of the stream.

    State holds every key seen, so it grows with the number of keys, not of rows. ``salts`` above 1
    adds the first pass, with up to ``salts`` more entries per key.
    """
    if salts > 1:
        df = df.withColumn(_SALT, _salt(salts)).dropDuplicates([*keys, _SALT]).drop(_SALT)
    return df.dropDuplicates(list(keys))


def stream_first_seen_within(
    df: DataFrame, keys: Sequence[str], event_time: str, horizon: str, salts: int = 1
) -> DataFrame:
    """First row per key within ``horizon`` of event time; a key may reappear after it.

    State is dropped as the watermark passes, so it is bounded by the keys of one horizon. The first
    pass keys on the event time as well, so its own state expires with the watermark; it removes
    only rows whose key and event time are those of a row already let through.
    """
    df = df.withWatermark(event_time, horizon)
    if salts > 1:
        df = (
            df.withColumn(_SALT, _salt(salts))
            .dropDuplicates([*keys, event_time, _SALT])
            .drop(_SALT)
        )
    return df.dropDuplicatesWithinWatermark(list(keys))
