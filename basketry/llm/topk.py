"""Exact top-k search by term-at-a-time accumulation (operator 8).

Queries and candidates are dealt into blocks; every pair of blocks meets in one task. There each
term (vector position) has a posting list of candidates and weights. A query adds, term after term,
its weight times the postings into a dense array of scores; partition selection takes the best k,
and a window over the k best of each block merges them. The work is queries times candidates, as an
exhaustive search must be; memory is bounded by the block sizes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm.shared import slice_count, staged

QUERIES_PER_BLOCK = 16_384
CANDIDATES_PER_BLOCK = 4096
#: Queries whose dense score arrays a task holds at once.
STRIP = 128


def scaled(vector: Column, scale: int = 64) -> Column:
    """floor(scale * x) of each component x, as a double; NULL where the vector takes no part."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    whole = F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))
    return F.when(vector.isNotNull() & ~bad, whole)


def _matrix(vectors: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width), np.int64)
    for row, v in enumerate(vectors):
        out[row, :len(v)] = v
    return out


def best_in_block(queries: pd.DataFrame, candidates: pd.DataFrame, k: int) -> Iterator[pd.DataFrame]:
    """The k best candidates of each query, higher score first, then smaller id."""
    candidates = candidates.sort_values("vec_id")
    ids, n = candidates["vec_id"].to_numpy(), len(candidates)
    width = max(max(map(len, queries["weights"])), max(map(len, candidates["weights"])))
    asked, held = _matrix(queries["weights"], width), _matrix(candidates["weights"], width)
    top = [float(np.abs(m.astype(float)).max(initial=0)) for m in (asked, held)]
    bound = top[0] * top[1] * max(width, 1)
    if bound < 2**31:
        asked, held = asked.astype(np.int32), held.astype(np.int32)
    postings = []
    for term in range(width):
        where = np.flatnonzero(held[:, term])
        dense = 2 * len(where) > n
        postings.append((slice(None) if dense else where, held[:, term].copy() if dense else held[where, term]))
    # Where a query's id stands among the sorted ids; several candidates may have it.
    own, past = (np.searchsorted(ids, queries["vec_id"].to_numpy(), side) for side in ("left", "right"))
    most = int((past - own).max(initial=0))
    for first in range(0, len(queries), STRIP):
        strip, low, high = asked[first:first + STRIP], own[first:first + STRIP], past[first:first + STRIP]
        scores = np.zeros((len(strip), n), strip.dtype)
        for term, (where, weights) in enumerate(postings):
            if len(weights) and strip[:, term].any():
                scores[:, where] += strip[:, term, None] * weights
        keep = np.minimum(k + most, n)  # more, as the query's id may be among its own best
        if bound * n < 2**62:
            order = scores.astype(np.int64) * n + np.arange(n - 1, -1, -1)
            best = np.argpartition(order, n - keep, axis=1)[:, n - keep:]
        else:
            best = np.argsort(-scores, axis=1, kind="stable")[:, :keep]
        rows = np.repeat(np.arange(len(strip)), keep)
        best = best.ravel()
        other = (best < low[rows]) | (best >= high[rows])
        rows, best = rows[other], best[other]
        # More than k of one pair are never needed.
        asked_often, held_often = (np.minimum(side["copies"].to_numpy(), k) for side in (queries, candidates))
        yield pd.DataFrame({
            "query_id": queries["vec_id"].to_numpy()[first + rows], "vec_id": ids[best],
            "score": scores[rows, best].astype(np.int64),
            "times": np.minimum(asked_often[first + rows] * held_often[best], k)})


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id",
          vector_col: str = "embedding", scale: int = 64,
          queries_per_block: int = QUERIES_PER_BLOCK,
          candidates_per_block: int = CANDIDATES_PER_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k highest inner products of each query, from 1 on.

    Vectors are scaled to integers by ``scaled``. All rows with another id than the query's are
    candidates; ties go to the smaller id. A vector that is NULL or has a NULL or non-finite component
    takes no part, nor does a row without an id. Rows that repeat an id are candidates each, also where
    they agree in the vector: these are scored once and listed as often as they occur. The k best
    of all pairs of a query's rows are those of its id. Shorter vectors count as filled with zeros. Scores are exact while they fit in 64 bits. With
    fewer than k candidates all are returned; an empty table gives an empty result.
    """
    rows = staged(
        vectors.filter(F.col(id_col).isNotNull())
        .select(F.col(id_col).cast("long").alias("vec_id"), is_query.alias("asks"),
                F.col(vector_col).alias("vector"), scaled(F.col(vector_col), scale).alias("weights"))
        .filter("weights is not null")
        .groupBy("vec_id", "vector").agg(F.min("weights").alias("weights"), F.max("asks").alias("asks"),
                                         F.count(F.lit(1)).alias("copies"))
        .select(F.monotonically_increasing_id().alias("row"), "vec_id", "weights", "asks", "copies"),
        "vectors",
    )
    blocks = slice_count(rows.filter("asks").count(), queries_per_block)
    parts = slice_count(rows.count(), candidates_per_block)
    asked = rows.filter("asks").select(
        F.pmod(F.xxhash64("row", F.lit(1)), F.lit(blocks)).alias("block"),
        F.explode(F.expr(f"sequence(0L, {parts - 1}L)")).alias("part"), "vec_id", "weights", "copies")
    held = rows.select(
        F.explode(F.expr(f"sequence(0L, {blocks - 1}L)")).alias("block"),
        F.pmod(F.xxhash64("row"), F.lit(parts)).alias("part"), "vec_id", "weights", "copies")

    def meet(queries: pd.DataFrame, candidates: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({c: np.empty(0, np.int64) for c in ("query_id", "vec_id", "score", "times")})
        if queries.empty or candidates.empty:
            return empty
        return pd.concat([empty, *best_in_block(queries, candidates, k)], ignore_index=True)

    found = asked.groupBy("block", "part").cogroup(held.groupBy("block", "part")).applyInPandas(
        meet, "query_id long, vec_id long, score long, times long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    distinct = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return (
        distinct.withColumn("time", F.explode(F.expr("sequence(1L, times)")))
        .withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
