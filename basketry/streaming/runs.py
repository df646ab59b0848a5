"""Triggered queries: process everything new since the last run, then stop.

Stateless streams and the frames handed to ``foreachBatch`` are planned adaptively, so run-time
broadcasts, skew-join splitting and rebalancing apply to them; stateful streams keep the number of
shuffle partitions they were started with.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from basketry.sources import tables


def start_batches(
    stream: DataFrame,
    checkpoint: str,
    each_batch: Callable[[DataFrame, int], None],
) -> StreamingQuery:
    """Hand the new rows to ``each_batch``. A batch may be handed over again after a failure, with
    the same id and rows, so ``each_batch`` must replace what it wrote for that id."""
    return (
        stream.writeStream.foreachBatch(each_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def start_append(
    stream: DataFrame, checkpoint: str, path: str, partition_by: Sequence[str] = ()
) -> StreamingQuery:
    """Append the new rows to a table of batch folders (``tables.batches`` reads it), exactly once: a
    batch that is run again replaces its folder.

    Rows are rebalanced by the partition columns, so a batch has one file per partition of ordinary
    size, however many tasks made its rows, and several where a partition is large.
    """

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        tables.write_batch(tables.balanced(batch, partition_by), path, batch_id, partition_by)

    return start_batches(stream, checkpoint, each_batch)


def finish(queries: Iterable[StreamingQuery]) -> list[StreamingQuery]:
    """Wait for queries that run side by side. As soon as one fails, the others are stopped and the
    failure is raised."""
    queries = list(queries)
    waiting = list(queries)
    try:
        while waiting:
            waiting = [q for q in waiting if not q.awaitTermination(0.2)]
    except Exception:
        for query in queries:
            query.stop()
        raise
    return queries


def drain(
    stream: DataFrame, checkpoint: str, each_batch: Callable[[DataFrame, int], None]
) -> StreamingQuery:
    return finish([start_batches(stream, checkpoint, each_batch)])[0]


def append(
    stream: DataFrame, checkpoint: str, path: str, partition_by: Sequence[str] = ()
) -> StreamingQuery:
    return finish([start_append(stream, checkpoint, path, partition_by)])[0]

