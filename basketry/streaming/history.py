"""Type-2 history kept up to date batch by batch.

Keys are dealt into buckets by hash. On disk a history has three parts:

``log``       observations of every batch, one row per key and sequence: the truth
``versions``  the history, complete, one folder per bucket, with two slots that take turns
``commits``   one small table per finished batch that names the current slot of each bucket

A batch rewrites the buckets of its keys and no other: it reads the slot that the last commit names and
writes the other one, so what is read is never overwritten, and a batch that is run again after a
failure finds its input as it was. Readers go by the last commit. What a batch costs follows its keys,
not the size of the history, as long as they fall into few of the buckets.

A key whose new rows all come after everything seen of it needs only its open version and those rows.
Only keys with late rows are worked out again, from the buckets of the log that have any; a batch
without late rows does not read the log. The other keys of a bucket are copied.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from basketry.contracts import END_AT, START_AT
from basketry.operators import scd2
from basketry.sources import tables

# Greatest sequence seen of a key, kept with its open version.
LAST_SEEN = "_last_seen"
BUCKET = "_bucket"
# Buckets of a history: each is rewritten as a whole, and the commit has one row for each. Give a large
# dimension more of them, before its first batch.
BUCKETS = 16
_SLOTS = T.StructType([T.StructField(n, T.IntegerType()) for n in (BUCKET, "slot")])
# A row of every commit, so that one without buckets is seen; it holds their number.
_ALL = -1


@dataclass(frozen=True)
class History:
    root: str
    keys: Sequence[str]
    sequence_by: str
    columns: Sequence[str]
    schema: T.StructType
    track: Sequence[str] | None = None
    split: dict = field(default_factory=dict)
    buckets: int = BUCKETS

    @property
    def _log(self) -> str:
        return f"{self.root}/log"

    @property
    def _commits(self) -> str:
        return f"{self.root}/commits"

    @property
    def _touched(self) -> str:
        return f"{self.root}/touched"

    def _bucket(self) -> Column:
        return F.pmod(F.hash(*self.keys), F.lit(self.buckets)).cast("int").alias(BUCKET)

    def _slots(self, spark: SparkSession, before: int | None = None) -> dict[int, int]:
        """The current slot of each bucket that has one; ``buckets`` entries at most."""
        _, rows = tables.last_commit(spark, self._commits, _SLOTS, self.buckets + 1, before)
        slots = {row[BUCKET]: row["slot"] for row in rows}
        if slots.pop(_ALL, self.buckets) != self.buckets:
            raise ValueError(f"{self.root} was not written with {self.buckets} buckets")
        return slots

    def _versions(self, spark: SparkSession, slots: dict[int, int]) -> DataFrame:
        paths = [f"{self.root}/versions/{BUCKET}={b}/slot={s}" for b, s in sorted(slots.items())]
        if not paths:
            return spark.createDataFrame([], self._version_schema())
        return spark.read.schema(self._version_schema()).parquet(*paths)

    def _stored(self) -> list[str]:
        ties = [c for c in scd2.LATER_FILE if c in self.schema.names]
        return list(dict.fromkeys([*self.keys, *self.columns, self.sequence_by, *ties]))

    def _log_schema(self) -> T.StructType:
        stored = [self.schema[name] for name in self._stored()]
        return T.StructType([*stored, T.StructField(BUCKET, T.IntegerType())])

    def _version_schema(self) -> T.StructType:
        at = self.schema[self.sequence_by].dataType
        return T.StructType(
            [
                *[self.schema[name] for name in self.columns],
                *[T.StructField(name, at) for name in (START_AT, END_AT, LAST_SEEN)],
            ]
        )

    def create(self, spark: SparkSession) -> None:
        """An empty history, unless there is one."""
        tables.create(spark, self._log, self._log_schema())
        tables.create(spark, self._commits, _SLOTS)

    def upsert(self, batch: DataFrame, batch_id: int) -> None:
        """Add a batch of feed rows; use as the function of ``foreachBatch``.

        Rows with a NULL key identify nothing and are left out.
        """
        spark, keys, at = batch.sparkSession, list(self.keys), self.sequence_by
        slots = self._slots(spark, before=batch_id)
        known = batch.dropna(subset=keys)
        seen = scd2.observations(known, keys, at, self.columns).select("*", self._bucket())
        tables.write_batch(tables.balanced(seen, [BUCKET]), self._log, batch_id, [BUCKET])
        new = tables.one_batch(spark, self._log, self._log_schema(), batch_id)

        mine = [row[BUCKET] for row in new.select(BUCKET).distinct().collect()]
        before = self._versions(spark, {b: slots[b] for b in mine if b in slots})
        still_open = before.filter(F.col(END_AT).isNull())

        # One row per key of the batch: is any of it late, and how far does the key now reach?
        joined = (
            new.groupBy(BUCKET, *keys)
            .agg(F.min(at).alias("_first"), F.max(at).alias("_newest"))
            .join(still_open.select(*keys, LAST_SEEN), keys, "left")
            .select(
                BUCKET,
                *keys,
                F.coalesce(F.col("_first") <= F.col(LAST_SEEN), F.lit(False)).alias("_late"),
                F.greatest("_newest", LAST_SEEN).alias("_reach"),
            )
        )
        # Stored beside the history, in one place that every batch replaces.
        tables.refresh(joined, self._touched)
        touched = tables.snapshot(spark, self._touched, joined.schema)
        late = touched.filter("_late").select(*keys)
        in_order = touched.filter("NOT _late").select(*keys)

        opened = still_open.join(in_order, keys, "left_semi").withColumn(at, F.col(START_AT))
        # What is open came before the new rows, so it needs no time of its file.
        rows = new.join(in_order, keys, "left_semi").select(*self._stored()).unionByName(
            opened.select(*scd2.present(opened, self._stored())), allowMissingColumns=True
        )
        with_late = [row[BUCKET] for row in touched.filter("_late").select(BUCKET).distinct().collect()]
        if with_late:
            # A later batch may lie in the log already if this one is being run again.
            log = tables.batches(spark, self._log, self._log_schema(), up_to=batch_id)
            late_rows = log.filter(F.col(BUCKET).isin(with_late)).join(late, keys, "left_semi")
            rows = rows.unionByName(late_rows.select(*self._stored()))
        changed = (
            scd2.versions(rows, keys, at, self.columns, self.track, **self.split)
            .join(touched.select(*keys, "_reach"), keys)
            .withColumn(LAST_SEEN, F.when(F.col(END_AT).isNull(), F.col("_reach")))
            .drop("_reach")
        )
        # Closed versions of keys in order stay; their open ones are in ``changed``.
        kept = before.join(touched.select(*keys, "_late"), keys, "left").filter(
            F.col("_late").isNull() | (~F.col("_late") & F.col(END_AT).isNotNull())
        )
        turned = {b: 1 - slots.get(b, 1) for b in mine}
        if turned:
            now = F.element_at(F.create_map(*[F.lit(x) for pair in turned.items() for x in pair]), F.col(BUCKET))
            written = kept.drop("_late").unionByName(changed).select(
                *self._version_schema().names, self._bucket()
            )
            tables.replace_folders(
                tables.balanced(written, [BUCKET]).withColumn("slot", now),
                f"{self.root}/versions", [BUCKET, "slot"],
            )
        named = [(_ALL, self.buckets), *sorted((slots | turned).items())]
        tables.commit(spark.createDataFrame(named, _SLOTS), self._commits, batch_id)

    def read(self, spark: SparkSession) -> DataFrame:
        """The history as of the last finished batch."""
        return self._versions(spark, self._slots(spark)).drop(LAST_SEEN)
