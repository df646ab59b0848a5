"""Approximate nearest neighbours by a permutation index (operator 13).

A vector is represented by its nearest pivots, in order of nearness. The index stores this prefix with
the vector. In a part of the index, every pivot has an inverted file: the vectors that hold the pivot in
their prefix, and its position there. A query reads the files of its own pivots only and adds up, per
vector, by how much less than the full penalty the two positions differ; that is the footrule distance of
the two prefixes, where a missing pivot stands behind the last position. The vectors of the smallest
footrule distance are ranked again by the inner product itself.

Queries and vectors are dealt into blocks and parts by row; each pair of a block and a part is a task, so no
pivot, however common, gathers in one. A part reranks a share of its vectors, whatever the size of the
table. Equal vectors are one entry of a part, so that a vector with very many copies does not crowd out others.

Inner products are not distances. As is usual, vectors get one more component that brings all to the length of
the longest, and queries a zero there; then the nearest by angle are those of the largest inner product.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm.shared import slice_count, staged

#: Pivots of the index, drawn from the vectors by hash, and how many of them represent a vector.
PIVOTS, PREFIX = 256, 64
#: Vectors of a part that are reranked: so many, and one in ``SHARE`` beyond.
LEAST, SHARE = 256, 16
QUERIES_PER_BLOCK, VECTORS_PER_PART = 16_384, 4096
#: Queries whose dense footrule arrays a task holds at once.
STRIP = 128

INDEX = "row long, vec_id long, asks boolean, vector binary, prefix binary, asked binary"
FOUND = "query_id long, vec_id long, score double"


def usable(vector: Column) -> Column:
    """TRUE for vectors that take part."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~bad & F.exists(vector, lambda x: x != 0)


def _matrix(vectors: pa.Array, width: int) -> np.ndarray:
    """The vectors as rows, filled with zeros."""
    sizes = vectors.value_lengths().to_numpy(zero_copy_only=False)
    values = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    out = np.zeros((len(vectors), width))
    out[np.arange(width) < sizes[:, None]] = values
    return out


def lengthened(vectors: np.ndarray, longest: float) -> np.ndarray:
    """Vectors in units of the longest, with the component that brings each to length 1."""
    unit = vectors / longest
    return np.hstack([unit, np.sqrt(np.clip(1 - (unit * unit).sum(1, keepdims=True), 0, None))])


def prefixes(near: np.ndarray, length: int) -> np.ndarray:
    """The ``length`` nearest pivots of each row of a matrix of nearness, in order; ties by number."""
    return np.argsort(-near, axis=1, kind="stable")[:, :length].astype(np.uint16)


def inverted_files(prefix: np.ndarray, pivots: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each pivot, the rows that hold it in their prefix and its positions there."""
    n, length = prefix.shape
    flat = prefix.ravel()
    order = np.argsort(flat, kind="stable")
    cuts = np.searchsorted(flat[order], np.arange(pivots + 1))
    rows, places = order // length, (order % length).astype(np.int16)
    return [(rows[a:b], places[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def nearness_of_prefixes(asked: np.ndarray, files: list[tuple[np.ndarray, np.ndarray]], n: int) -> np.ndarray:
    """Half of what the footrule distance of each query to each of ``n`` vectors is below the greatest."""
    length = asked.shape[1]
    gain = np.zeros((len(asked), n), np.int32)
    for pivot, (rows, places) in enumerate(inverted_files(asked, len(files))):
        held, at = files[pivot]
        if len(rows) and len(held):
            # One side alone costs length - place; both cost the gap. What is saved is twice this.
            gain[rows[:, None], held] += length - np.maximum(places[:, None], at)
    return gain


def _distinct(ids: np.ndarray, vectors: list[bytes], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of a part sorted by vector and id, without those no query can need.

    Returns (row of each kept entry, number of its distinct vector, first row of each distinct vector). Of equal
    vectors, k rows of an id are enough, and of these 2 k: a query leaves out one id.
    """
    number = pd.factorize(pd.Series(vectors, dtype=object))[0]
    order = np.lexsort((ids, number))
    frame = pd.DataFrame({"row": order, "number": number[order], "id": ids[order]})
    frame = frame[frame.groupby(["number", "id"]).cumcount() < k]
    frame = frame[frame.groupby("number").cumcount() < 2 * k]
    first = frame["row"].to_numpy()[~frame["number"].duplicated().to_numpy()]
    return frame["row"].to_numpy(), frame["number"].to_numpy(), first


def found_in_part(queries: pd.DataFrame, held: pd.DataFrame, k: int, pivots: int, share: int = SHARE,
                  least: int = LEAST) -> Iterator[pd.DataFrame]:
    """The k best found of each query, by inner product, then id."""
    ids = held["vec_id"].to_numpy()
    rows, number, first = _distinct(ids, held["vector"].tolist(), k)
    vectors = np.stack([np.frombuffer(held["vector"].iloc[r], np.float64) for r in first])
    prefix = np.stack([np.frombuffer(held["prefix"].iloc[r], np.uint16) for r in first])
    sizes, ids = np.bincount(number), ids[rows]
    starts = np.cumsum(sizes) - sizes
    # The smallest id first, so that ties go to it below.
    by_id = np.argsort(ids[starts], kind="stable")
    vectors, prefix, sizes, starts = vectors[by_id], prefix[by_id], sizes[by_id], starts[by_id]
    n, files, columns = len(first), inverted_files(prefix, pivots), np.ascontiguousarray(vectors.T)
    again = min(n, least + n // share)
    for begin in range(0, len(queries), STRIP):
        strip = queries.iloc[begin:begin + STRIP]
        asked = np.stack([np.frombuffer(v, np.float64) for v in strip["vector"]])
        gain = nearness_of_prefixes(np.stack([np.frombuffer(p, np.uint16) for p in strip["asked"]]), files, n)
        # Ties in footrule go to the smaller id, so the choice does not depend on the order of rows.
        ranked = gain.astype(np.int64) * n + np.arange(n - 1, -1, -1)
        best = np.sort(np.argpartition(ranked, n - again, axis=1)[:, n - again:], axis=1)
        score = np.zeros(best.shape)
        for c, column in enumerate(columns):  # from the first component to the last, as one writes it
            score += asked[:, c, None] * column[best]
        keep = min(again, k + 1)
        top = np.argsort(-score, axis=1, kind="stable")[:, :keep]
        at, points = np.take_along_axis(best, top, 1).ravel(), np.take_along_axis(score, top, 1).ravel()
        asks = np.repeat(np.arange(len(strip)), keep)
        # Every row of the distinct vectors that are left.
        times = sizes[at]
        entry = np.repeat(starts[at] - (np.cumsum(times) - times), times) + np.arange(times.sum())
        out = pd.DataFrame({"query_id": strip["vec_id"].to_numpy()[np.repeat(asks, times)], "vec_id": ids[entry],
                            "score": np.repeat(points, times), "asks": np.repeat(asks, times)})
        out = out[out["query_id"] != out["vec_id"]].sort_values(["asks", "score", "vec_id"], ascending=[True, False, True])
        yield out[out.groupby("asks").cumcount() < k].drop(columns="asks")


def neighbours(vectors: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding",
               pivots: int = PIVOTS, prefix: int = PREFIX, share: int = SHARE, least: int = LEAST,
               queries_per_block: int = QUERIES_PER_BLOCK, vectors_per_part: int = VECTORS_PER_PART) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k nearest found of each query, by largest inner product.

    All rows with another id than the query's are candidates; ties go to the smaller id. ``score`` adds the
    products of the components in double precision, from the first to the last; shorter vectors count as filled
    with zeros. Rows that repeat an id, or an id and a vector, are candidates each; as queries, rows that share an id
    are one, and the k best of all of them are its own. A vector that is NULL, zero or has a NULL or non-finite
    component takes no part, nor does a row without an id. With fewer than k candidates all are returned: every part
    ranks ``least`` vectors at least. An empty table gives an empty result.

    Which pivots are drawn, and what is found, depends on the table alone, apart from the number of parts.
    """
    rows = (
        vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.coalesce(is_query, F.lit(False)).alias("asks"),
                       F.col(vector_col).cast("array<double>").alias("vector"))
        .filter(F.col("vec_id").isNotNull() & usable(F.col("vector")))
    )
    square = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x)
    known = rows.agg(F.max(F.sqrt(square)).alias("longest"), F.max(F.size("vector")).alias("width"),
                     F.count(F.lit(1)).alias("rows"), F.count_if("asks").alias("queries")).first()
    if not known["rows"]:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    longest, width = known["longest"], known["width"]
    longest = longest if 0 < longest < float("inf") else 1e154
    # By distinct hash: a common vector is one pivot at most.
    marked = rows.select(F.xxhash64("vector").alias("h"), "vector")
    least_hashes = marked.select("h").distinct().orderBy("h").limit(pivots)
    drawn = marked.join(F.broadcast(least_hashes), "h").groupBy("h").agg(F.min("vector").alias("vector"))
    chosen = [r["vector"] for r in drawn.orderBy("h").collect()]
    near_to = lengthened(_matrix(pa.array(chosen, pa.list_(pa.float64())), width), longest)
    length = min(prefix, len(chosen))

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            plain = _matrix(batch.column("vector"), width)
            own = lengthened(plain, longest)
            asked = prefixes(own[:, :-1] @ near_to[:, :-1].T, length)
            posted = prefixes(own @ near_to.T, length)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("row", "vec_id", "asks")),
                 *(pa.array([r.tobytes() for r in m], pa.binary()) for m in (plain, posted, asked))],
                ["row", "vec_id", "asks", "vector", "prefix", "asked"])

    index = staged(rows.withColumn("row", F.monotonically_increasing_id()).mapInArrow(post, INDEX), "permutations")
    blocks, parts = slice_count(known["queries"], queries_per_block), slice_count(known["rows"], vectors_per_part)
    asked = index.filter("asks").dropDuplicates(["vec_id", "vector"]).select(
        F.pmod(F.xxhash64("row", F.lit(1)), F.lit(blocks)).alias("block"),
        F.explode(F.expr(f"sequence(0L, {parts - 1}L)")).alias("part"), "vec_id", "vector", "asked")
    held = index.select(
        F.explode(F.expr(f"sequence(0L, {blocks - 1}L)")).alias("block"),
        F.pmod(F.xxhash64("row"), F.lit(parts)).alias("part"), "vec_id", "vector", "prefix")

    def meet(queries: pd.DataFrame, candidates: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"query_id": np.empty(0, np.int64), "vec_id": np.empty(0, np.int64), "score": np.empty(0)})
        if queries.empty or candidates.empty:
            return empty
        return pd.concat([empty, *found_in_part(queries, candidates, k, len(chosen), share, least)], ignore_index=True)

    found = asked.groupBy("block", "part").cogroup(held.groupBy("block", "part")).applyInPandas(meet, FOUND)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
