"""First row per key within a horizon of event time, with the late rows in a table of their own.

``dropDuplicatesWithinWatermark`` sends every row to the task of its key and drops late rows, of which
only the number remains. Here a batch is reduced to one row per key and map task before its shuffle, and
checked against the keys that the horizon still covers; no other key is read, since row groups of expired
ones are skipped by their statistics.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from basketry.operators.dedup import first_per_key
from basketry.sources import tables

_MARK = T.StructType([T.StructField("latest", T.LongType())])


@dataclass(frozen=True)
class FirstInTime:
    """A table of first rows at ``path`` and one of late rows at ``late_path``.

    The watermark of a batch is the latest event time of the batches before it, less ``horizon``. Rows at
    or behind it are late, whether their key is known or not. The key of a stored row is forgotten once
    the watermark is ``horizon`` past its event time; its next row is let in again. Rows without an
    event time are never late, and their keys never forgotten.
    """

    path: str
    late_path: str
    marks: str
    keys: Sequence[str]
    event_time: str
    horizon: str
    order: Sequence[str]
    schema: T.StructType
    partition_by: Sequence[str] = ()

    def create(self, spark: SparkSession) -> None:
        for path, schema in ((self.path, self.schema), (self.late_path, self.schema), (self.marks, _MARK)):
            tables.create(spark, path, schema)

    def add(self, batch: DataFrame, batch_id: int) -> None:
        """Use as the function of ``foreachBatch``. Only earlier batches count, so a batch that runs
        again replaces what it wrote."""
        spark, at = batch.sparkSession, F.col(self.event_time)
        _, rows = tables.last_commit(spark, self.marks, _MARK, 1, before=batch_id)
        before = rows[0]["latest"] if rows else None
        late = F.coalesce(at <= self._behind(before, 1), F.lit(False))
        fresh = first_per_key(batch.filter(~late), self.keys, [self.event_time, *self.order])
        if batch_id > 0:
            stored = tables.batches(spark, self.path, self.schema, batch_id - 1)
            known = stored.filter(F.coalesce(at > self._behind(before, 2), F.lit(True))).select(*self.keys)
            fresh = fresh.join(known, list(self.keys), "left_anti")
        tables.write_batch(tables.balanced(fresh, self.partition_by), self.path, batch_id, self.partition_by)
        tables.write_batch(tables.balanced(batch.filter(late)), self.late_path, batch_id)
        latest = F.greatest(F.max(F.unix_micros(at.cast("timestamp"))), F.lit(before).cast("long"))
        tables.commit(batch.agg(latest.alias("latest")), self.marks, batch_id)

    def _behind(self, latest: int | None, times: int) -> Column:
        """``times`` horizons before ``latest``, in microseconds; NULL without one."""
        span = F.expr(f"interval {self.horizon}")
        moment = F.timestamp_micros(F.lit(latest).cast("long"))
        for _ in range(times):
            moment = moment - span
        return moment

    def read(self, spark: SparkSession) -> DataFrame:
        return tables.batches(spark, self.path, self.schema)

    def late(self, spark: SparkSession) -> DataFrame:
        return tables.batches(spark, self.late_path, self.schema)
