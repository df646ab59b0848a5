"""Packing documents into sequences with a controlled mixture (operator 6).

Documents are encoded once and dealt by hash into slices of bounded size. In a slice every source is
a queue of token ids. Deficit round-robin fills one window after another: each source's deficit
grows by its target share of the window, it gives that many ids, and what it could not give or gave
too much is carried to the next window. Deficits also pass from slice to slice: a slice starts with
what its sources are short of over all slices before it, which is a sum over small tables, so
slices are packed side by side. Documents are cut where a window ends.

The last ids of a slice fill sequences whose lengths are powers of two, so nothing is padded.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm.shared import dealt_by_hash, slice_count, staged
from basketry.llm.token_files import END_ID, serialised, vocabulary_width
from basketry.llm.tokens import encoder
from basketry.llm.words import slices

WINDOW = 4096
ROWS_PER_SLICE = 2048

PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
          "offset long")


def encoded(docs: DataFrame, path: str, spaced: bool, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """(doc_id, source, spread, tokens, ids): ``ids`` are the serialised ids with the end id."""
    width = vocabulary_width(path)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                ids = encoder(path, spaced).encode(batch.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c) for c in ("doc_id", "source", "spread")),
                     pa.array([len(i) + 1 for i in ids], pa.int64()),
                     pa.array([serialised(i, width) for i in ids], pa.binary())],
                    ["doc_id", "source", "spread", "tokens", "ids"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"),
                       F.xxhash64(id_col, text_col).alias("spread"), F.col(text_col).alias("text"))
    return rows.mapInArrow(encode, "doc_id long, source string, spread long, tokens long, ids binary")


def window_lengths(total: int, window: int) -> list[int]:
    """Full windows, then the powers of two that make up the rest."""
    rest = total % window
    return [window] * (total // window) + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def quotas(left: list[int], share: list[float], deficit: list[float], lengths: list[int]) -> Iterator[list[int]]:
    """Deficit round-robin: how many ids each source gives to each window; ``deficit`` is carried."""
    sources = range(len(left))
    for length in lengths:
        room, take = length, [0] * len(left)
        for s in sources:
            deficit[s] += share[s] * length
        for s in sorted(sources, key=lambda s: -deficit[s]):
            take[s] = max(0, min(left[s], int(deficit[s]), room))
            room -= take[s]
        # Shares are fractions, and queues run dry: the rest goes to the others by their shares, and
        # what is less than one id each, to those with the greatest deficit.
        while room:
            open_ = sorted((s for s in sources if left[s] > take[s]), key=lambda s: take[s] - deficit[s])
            whole = sum(share[s] for s in open_)
            for s in open_ if room >= len(open_) else open_[:room]:
                more = int(room * share[s] / whole) if whole and room >= len(open_) else 1
                more = min(max(more, 1), left[s] - take[s], room)
                take[s] += more
                room -= more
        for s in sources:
            deficit[s] -= take[s]
            left[s] -= take[s]
        yield take


def packed_slice(docs: pa.Table, cells: pa.Table, window: int, width: int) -> pa.Table:
    """The pieces of one slice."""
    cell = {c["source"]: c for c in cells.to_pylist()}
    queues: dict[str | None, list[dict]] = {}
    for row in sorted(docs.to_pylist(), key=lambda r: (r["spread"], r["doc_id"] is None, r["doc_id"] or 0, r["ids"])):
        queues.setdefault(row["source"], []).append(row)
    names = sorted(queues, key=lambda s: (s is None, s or ""))
    left = [sum(r["tokens"] for r in queues[s]) for s in names]
    lengths = window_lengths(sum(left), window)
    share, deficit = [cell[s]["share"] for s in names], [cell[s]["deficit"] for s in names]
    base = docs.column("slice")[0].as_py() << 32
    out: list[tuple] = []
    heads = [iter(queues[s]) for s in names]
    own: list[dict | None] = [None] * len(names)
    for number, take in enumerate(quotas(left, share, deficit, lengths)):
        offset = 0
        for s, want in enumerate(take):
            while want:
                if own[s] is None:
                    row = next(heads[s])
                    own[s] = {**row, "at": 0, "raw": np.frombuffer(row["ids"], f"<u{width}").astype("<u4")}
                row = own[s]
                n = min(want, row["tokens"] - row["at"])
                out.append((row["doc_id"], row["at"], n, zlib.crc32(row["raw"][row["at"]:row["at"] + n]),
                            row["tokens"], base + number, offset))
                row["at"], offset, want = row["at"] + n, offset + n, want - n
                if row["at"] == row["tokens"]:
                    own[s] = None
    columns = list(zip(*out, strict=True))
    return pa.table({c.split()[0]: pa.array(v, pa.int64()) for c, v in zip(PIECES.split(", "), columns, strict=True)})


def packed(docs: DataFrame, path: str, spaced: bool = False, id_col: str = "doc_id", text_col: str = "text",
           source_col: str = "source", window: int = WINDOW, rows_per_slice: int = ROWS_PER_SLICE,
           shares: DataFrame | None = None) -> DataFrame:
    """Pieces of all documents: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    ``shares`` (source, share) gives target proportions; without it they are the sources' parts of all
    ids. Every id lies in one piece; pieces of a sequence follow each other from offset 0.
    A sequence holds ``window`` ids, or a power of two. A NULL or empty text is the end id alone; NULL
    is a source of its own. Rows that repeat an id are packed each on its own, in several slices if they
    also agree in text and fill more than one. An empty table gives an empty result.
    """
    rows = staged(encoded(docs, path, spaced, id_col, text_col, source_col)
                  .withColumn("row", F.monotonically_increasing_id()), "encoded")
    count = slice_count(rows.count(), rows_per_slice)
    rows = dealt_by_hash(rows, "slice", count, rows_per_slice)
    cells = staged(rows.groupBy("slice", "source").agg(F.sum("tokens").alias("tokens")), "cells")
    total = cells.agg(F.sum("tokens")).first()[0] or 0
    earlier = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    at = cells.groupBy("slice").agg(F.sum("tokens").alias("n")).select(
        "slice", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    own = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    if shares is None:
        shares = cells.groupBy("source").agg((F.sum("tokens") / F.lit(total or 1)).alias("share"))
    given = shares.select(F.col("source").alias("of"), "share")
    carried = (
        cells.withColumn("gave", F.coalesce(F.sum("tokens").over(own), F.lit(0))).join(at, "slice")
        .join(given, F.col("source").eqNullSafe(F.col("of")), "left")
        .select("slice", "source", F.coalesce("share", F.lit(0.0)).alias("share"),
                (F.coalesce("share", F.lit(0.0)) * F.col("before") - F.col("gave")).alias("deficit"))
    )
    width = vocabulary_width(path)
    return rows.groupBy("slice").cogroup(carried.groupBy("slice")).applyInArrow(
        lambda docs, cells: packed_slice(docs, cells, window, width), PIECES)
