"""Compression of vectors to codes of learned codebooks (operator 11).

Vectors are cut into parts, and every part position has a codebook of its own. Nearest entries are
searched through a geometric near-neighbour access tree (GNAT) over the entries of a codebook: a node
holds a few entries as split points, every other entry goes to the child of its nearest split point, and
for each pair of split point and child the range of distances between them is stored. A query that is at
distance d of a split point and knows an entry at distance r or less needs a child only if its range
meets [d - r, d + r]; one that fails this for a single split point goes, with its whole subtree.

All numbers are integers. Distances are compared as their squares; in the test of a range, square
roots are rounded down or up so that the range only grows, and it must be missed strictly. So no entry
that ties with the best is lost, and ties are decided on the integers, to the lower index.

Codebooks are small and go to every task. A task assigns its rows and returns one sum per entry, so
a round of learning shuffles a few rows per task, however the rows are distributed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm.shared import split_join, staged

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Split points of a node.
SPLITS = 4
#: Components below this keep all sums of squares of a part within 64 bits; larger ones use Python's integers.
SMALL = 1 << 28
#: Rows assigned at once.
STRIP = 8192
#: Largest value of a long.
LONG = 2**63 - 1

SUMS = "part int, entry int, n long, sums array<decimal(38,0)>"


def _root(squares: np.ndarray) -> np.ndarray:
    """Whole part of the square root of each non-negative integer."""
    if squares.dtype == object:
        from math import isqrt

        return np.array([isqrt(s) for s in squares.ravel()], object).reshape(squares.shape)
    low = np.sqrt(squares.astype(np.float64)).astype(np.int64)
    low -= low * low > squares
    low += (low + 1) * (low + 1) <= squares
    return low


def _root_up(squares: np.ndarray) -> np.ndarray:
    low = _root(squares)
    return low + (low * low < squares)


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of the rows of ``a`` to those of ``b``, component after component."""
    out = np.zeros((len(a), len(b)), a.dtype)
    for k in range(a.shape[1]):
        gap = a[:, k, None] - b[None, :, k]
        out += gap * gap
    return out


@dataclass
class Node:
    """Split points (places among the entries), their children, and the distance of each split point to
    the nearest and farthest entry of each child, rounded outwards."""

    splits: np.ndarray
    children: list[Node | None] = field(default_factory=list)
    low: np.ndarray | None = None
    high: np.ndarray | None = None


def gnat(entries: np.ndarray, places: np.ndarray | None = None, splits: int = SPLITS) -> Node:
    """The tree over ``entries``. Split points are taken far from one another."""
    places = np.arange(len(entries)) if places is None else places
    if len(places) <= splits:
        return Node(places)
    gaps = squared(entries[places], entries[places])
    chosen = [0]
    while len(chosen) < splits:
        near = gaps[chosen].min(axis=0)
        near[chosen] = -1
        chosen.append(int(np.argmax(near)))
    rest = np.setdiff1d(np.arange(len(places)), chosen)
    owner = np.argmin(gaps[chosen][:, rest], axis=0)
    node = Node(places[chosen])
    low, high = np.zeros((splits, splits), gaps.dtype), np.zeros((splits, splits), gaps.dtype)
    for j in range(splits):
        own = rest[owner == j]
        node.children.append(gnat(entries, places[own], splits) if len(own) else None)
        if len(own):
            low[:, j], high[:, j] = gaps[chosen][:, own].min(axis=1), gaps[chosen][:, own].max(axis=1)
    node.low, node.high = _root(low), _root_up(high)
    return node


def nearest(tree: Node, entries: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place of the nearest entry, squared distance) of each row; ties go to the lower place."""
    best = np.full(len(asked), -1, np.int64)
    reach = np.zeros(len(asked), asked.dtype)

    def visit(node: Node, rows: np.ndarray) -> None:
        away = squared(asked[rows], entries[node.splits])
        for k, place in enumerate(node.splits):
            held, at = best[rows], reach[rows]
            closer = (held < 0) | (away[:, k] < at) | ((away[:, k] == at) & (place < held))
            best[rows[closer]], reach[rows[closer]] = place, away[closer, k]
        if not node.children:
            return
        down, up, first = _root(away), _root_up(away), np.argmin(away, axis=1)
        # The child of the nearest split point first: it is likely to shorten the reach for the others.
        for own in (True, False):
            for j, child in enumerate(node.children):
                if child is None:
                    continue
                turn = np.flatnonzero((first == j) == own)
                radius = _root_up(reach[rows[turn]])[:, None]
                alive = ((down[turn] - radius <= node.high[:, j]) & (up[turn] + radius >= node.low[:, j])).all(axis=1)
                if alive.any():
                    visit(child, rows[turn[alive]])

    if len(asked):
        visit(tree, np.arange(len(asked)))
    return best, reach


class Codebooks:
    """Entries of every part position as whole numbers, with a tree over each."""

    def __init__(self, entries: list[list[list[int]]]) -> None:
        self.entries = entries
        big = any(abs(x) >= SMALL for part in entries for e in part for x in e)
        self.kind = object if big else np.int64
        self.arrays = [np.array(part, self.kind).reshape(len(part), len(part[0]) if part else 0) for part in entries]
        self.trees = [gnat(a) for a in self.arrays]

    def assign(self, whole: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(entries, squared distances) by row and part of an integer matrix."""
        kind = object if object in (whole.dtype, self.kind) else np.int64
        width = whole.shape[1] // len(self.arrays)
        codes, errors = [], []
        for p, (entries, tree) in enumerate(zip(self.arrays, self.trees, strict=True)):
            piece = whole[:, p * width:(p + 1) * width].astype(kind)
            place, reach = nearest(tree, entries.astype(kind), piece)
            codes.append(place)
            errors.append(reach)
        return np.stack(codes, axis=1), np.stack(errors, axis=1)

    def digest(self) -> str:
        return hashlib.sha256(",".join(str(x) for part in self.entries for e in part for x in e).encode()).hexdigest()


def usable(vector: Column) -> Column:
    """TRUE for vectors that are not NULL and hold finite components only."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~bad


def floors(vectors: pa.Array, width: int) -> np.ndarray:
    """floor(4096 * x) of the components of vectors of one length, as a matrix."""
    values = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    with np.errstate(over="ignore"):
        scaled = np.floor(values * SCALE)
    if len(values) and not np.abs(scaled).max() < SMALL:
        from math import floor

        return np.array([floor(x) * SCALE if abs(x) >= 2.0**53 else floor(x * SCALE) for x in values.tolist()],
                        object).reshape(len(vectors), width)
    return scaled.astype(np.int64).reshape(len(vectors), width)


def _strips(batch: pa.RecordBatch, width: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for first in range(0, batch.num_rows, STRIP):
        strip = batch.slice(first, STRIP)
        yield strip, floors(strip.column("vector"), width)


def _sums(rows: DataFrame, books: Codebooks, width: int) -> DataFrame:
    """Number and componentwise sum of the parts assigned to each entry."""
    step = width // len(books.arrays)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], list] = {}
        for batch in batches:
            for _, whole in _strips(batch, width):
                codes, _ = books.assign(whole)
                for p in range(codes.shape[1]):
                    for e in np.unique(codes[:, p]).tolist():
                        own = whole[codes[:, p] == e, p * step:(p + 1) * step]
                        total = held.setdefault((p, e), [0, [0] * step])
                        total[0] += len(own)
                        total[1] = [a + int(b) for a, b in zip(total[1], own.sum(axis=0), strict=True)]
        kinds = pa.schema([("part", pa.int32()), ("entry", pa.int32()), ("n", pa.int64()),
                           ("sums", pa.list_(pa.decimal128(38, 0)))])
        yield pa.RecordBatch.from_pylist(
            [{"part": p, "entry": e, "n": n, "sums": [Decimal(x) for x in sums]} for (p, e), (n, sums) in held.items()], kinds)

    each = rows.select("vector").mapInArrow(add, SUMS)
    return each.groupBy("part", "entry").agg(
        F.sum("n").alias("n"), *(F.sum(F.col("sums")[k]).alias(f"s{k}") for k in range(step)))


def learned(rows: DataFrame, width: int, entries: int = ENTRIES, parts: int = PARTS, rounds: int = ROUNDS) -> Codebooks:
    """Codebooks of (vec_id, vector) rows that all have ``width`` components."""
    step = width // parts
    first = rows.select("vec_id", "vector").orderBy(F.asc_nulls_last("vec_id"), "vector").limit(entries).collect()
    whole = floors(pa.array([r["vector"] for r in first], pa.list_(pa.float64())), width).tolist()
    found = [[row[p * step:(p + 1) * step] for row in whole] for p in range(parts)]
    for _ in range(rounds):
        sums = _sums(rows, Codebooks(found), width).collect()  # parts * entries rows at most
        for r in sums:
            found[r["part"]][r["entry"]] = [int(r[f"s{k}"]) // r["n"] for k in range(step)]
    return Codebooks(found)


def coded(rows: DataFrame, books: Codebooks, width: int) -> DataFrame:
    """(vec_id, label, code, error) of each row."""
    # The label passes through as it is, whatever its type.
    kinds = rows.select("vec_id", "label").withColumns({"code": F.lit("").cast("string"), "error": F.lit(0).cast("long")}).schema

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for strip, whole in _strips(batch, width):
                codes, errors = books.assign(whole)
                texts = ["".join(f"{e:02x}" for e in row) for row in codes.tolist()]
                totals = [t if t <= LONG else None for t in (sum(row) for row in errors.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [strip.column("vec_id"), strip.column("label"), pa.array(texts, pa.string()), pa.array(totals, pa.int64())],
                    ["vec_id", "label", "code", "error"])

    return rows.select("vec_id", "label", "vector").mapInArrow(encode, kinds)


def vector_codes(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                 entries: int = ENTRIES, parts: int = PARTS, rounds: int = ROUNDS) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of each vector.

    A component x counts as floor(4096 * x). A codebook starts as its part of the ``entries`` smallest ids
    (a NULL id comes last; rows that repeat an id are ordered by their vectors), so a table of fewer rows has
    fewer entries. Each of ``rounds`` assigns all parts, then replaces every used entry by the floor of the
    mean of its parts. ``code`` has two hexadecimal digits per part. ``error`` adds the squared distances,
    ``label_error`` the errors of all rows of equal label, NULLs together; one beyond 64 bits is NULL.

    A vector that is NULL or has a NULL or non-finite component is dropped; repeated rows are coded each. An
    empty table gives an empty result. Vectors of several lengths, of a length that ``parts`` does not
    divide, or more than 256 entries raise ValueError.
    """
    if entries > 256:
        raise ValueError("a code has two hexadecimal digits per part")
    rows = vectors.select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"),
        F.col(vector_col).cast("array<double>").alias("vector")).filter(usable(F.col("vector")))
    shape = rows.agg(F.min(F.size("vector")).alias("low"), F.max(F.size("vector")).alias("high")).first()
    width = shape["high"] or 0
    if width != (shape["low"] or 0):
        raise ValueError(f"vectors have {shape['low']} to {width} components")
    if width % parts:
        raise ValueError(f"{width} components cannot be cut into {parts} equal parts")
    books = learned(rows, width, entries, parts, rounds) if shape["high"] is not None else Codebooks([[] for _ in range(parts)])
    codes = staged(coded(rows, books, width), "codes")
    # Labels as a hash and a value: equal NULLs meet, and a label with very many rows can be split.
    marked = codes.withColumn("no_label", F.isnull("label"))
    key = F.when(F.col("no_label"), F.lit("")).otherwise(F.col("label").cast("string"))
    sums = marked.withColumn("label_key", key).groupBy("no_label", "label_key").agg(
        F.when(F.count("error") == F.count(F.lit(1)), F.expr("try_cast(sum(cast(error as decimal(38,0))) as long)")).alias("label_error"))
    return split_join(marked.withColumn("label_key", key), sums, ["no_label", "label_key"]).select(
        "vec_id", "code", "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256"))
