"""First row per key for tables that are small next to their feed.

``dropDuplicates`` on a stream sends every feed row to the task of its key. Customers and products
occur in so many sales that this would shuffle the whole feed to keep a sliver of it. Here a batch is
reduced before its shuffle, and what is left is checked against the keys stored so far.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, types as T

from basketry.operators.dedup import first_per_key
from basketry.sources import tables


@dataclass(frozen=True)
class FirstSeen:
    path: str
    keys: Sequence[str]
    order: Sequence[str]
    schema: T.StructType

    def add(self, batch: DataFrame, batch_id: int) -> None:
        """Store the rows of keys not seen before; use as the function of ``foreachBatch``.

        Only earlier batches count as seen, so running a batch again gives the same result.
        """
        fresh = first_per_key(batch, self.keys, self.order)
        if batch_id > 0:
            stored = tables.batches(batch.sparkSession, self.path, self.schema, batch_id - 1)
            fresh = fresh.join(stored.select(*self.keys), list(self.keys), "left_anti")
        tables.write_batch(fresh, self.path, batch_id)
