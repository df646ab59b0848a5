"""Join of documents by the Jaccard similarity of their word n-grams (operator 5).

Each text becomes the set of its 5-word n-grams, as 64-bit hashes. Texts with the same set are one
node, so copies are compared once. MinHash bands that two nodes share make them candidates, and
chains of candidates form families. In a family, pairs are pruned as in BayesLSH: MinHash values
are compared a few at a time, and a pair is dropped once the posterior probability that its
similarity reaches the threshold is below a tolerance. What is left is verified exactly on the sets.

No pairs leave the tasks: each returns, per node, its number of links and one edge towards its class.
A family is compared in blocks of bounded size, every pair of blocks in a task of its own, so a very
large family is many tasks. Sets are made only of texts that have a candidate.

The chance to miss a pair is bounded at the threshold itself: 3 in a million for the bands and
``TOLERANCE`` per comparison step; it falls steeply above.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.components import components
from basketry.llm.shared import maybe_in, split_join, staged, staying
from basketry.llm.words import U64, hashed, mixed, rolled, slices, split

WORDS, THRESHOLD = 5, 0.8
BANDS, ROWS = 32, 5
HASHES = BANDS * ROWS
#: MinHash values compared at a time, and the posterior probability below which a pair is dropped.
STEP, TOLERANCE = 32, 1e-8
#: Nodes of a family that meet in one task: twice as many at most.
BLOCK = 256
BASE = 0x9E3779B97F4A7C15
#: n-grams a task multiplies out at once.
CHUNK = 4096

NODES = "doc_id long, text_key long, row long, set_1 long, set_2 long, bands array<long>"
SETS = "set_1 long, set_2 long, signature binary, grams binary"
FOUND = "node long, root long, links long"


@lru_cache
def multipliers() -> np.ndarray:
    draw = np.random.default_rng(5)
    return draw.integers(1, 2**63, (HASHES, 1), dtype=U64) | U64(1)


def ngram_set(words: np.ndarray, n: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the word n-grams; a text of fewer words has one, of all its words."""
    if not len(words):
        return np.empty(0, U64)
    return np.unique(mixed(rolled(words, min(n, len(words)), BASE)))


def signature(grams: np.ndarray) -> np.ndarray:
    """MinHash values of a set: the least of each of many hashes."""
    low = np.full(HASHES, 2**64 - 1, U64)
    for first in range(0, len(grams), CHUNK):
        np.minimum(low, (grams[first:first + CHUNK] * multipliers()).min(1), out=low)
    return (low >> U64(32)).astype(np.uint32)


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, int, np.ndarray]]:
    """(batch, row, n-gram set) of each text."""
    for whole in batches:
        for batch in slices(whole, "text"):
            distinct, index, starts = split(batch.column("text"))
            words = hashed(distinct)[index]
            for row in range(batch.num_rows):
                yield batch, row, ngram_set(words[starts[row]:starts[row + 1]])


def _set_name(grams: np.ndarray) -> tuple[int, int]:
    """128 bits that name a set: two sums over its members, each mixed anew."""
    with np.errstate(over="ignore"):
        one = mixed(grams ^ U64(0x5851F42D4C957F2D)).sum(dtype=U64)
        two = mixed(grams ^ U64(0x14057B7EF767814F)).sum(dtype=U64)
    return int(one.view(np.int64)), int(two.view(np.int64))


def _nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = pa.schema([*((c, pa.int64()) for c in ("doc_id", "text_key", "row", "set_1", "set_2")),
                       ("bands", pa.list_(pa.int64()))])
    held: list[tuple] = []

    def made() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), kinds, strict=True)], schema=kinds)

    for batch, row, grams in _texts(batches):
        bands = np.empty(0, np.int64)
        if len(grams):
            values = signature(grams).astype(U64).reshape(BANDS, ROWS)
            name = np.arange(BANDS, dtype=U64)
            for k in range(ROWS):
                name = mixed(name * U64(BASE) + values[:, k])
            bands = name.view(np.int64)
        held.append((*(batch.column(c)[row].as_py() for c in kinds.names[:3]), *_set_name(grams), bands))
        if len(held) == 2048:
            yield made()
            held.clear()
    if held:
        yield made()


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = pa.schema([("set_1", pa.int64()), ("set_2", pa.int64()), ("signature", pa.binary()), ("grams", pa.binary())])
    for _, _, grams in _texts(batches):
        yield pa.RecordBatch.from_pylist([dict(zip(kinds.names, (
            *_set_name(grams), signature(grams).tobytes(), grams.tobytes()), strict=True))], kinds)


@lru_cache
def fewest_matches(compared: int, threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> int:
    """Matches among ``compared`` values with which a pair may still reach the threshold.

    Under a uniform prior the posterior of the similarity is Beta(m + 1, n - m + 1), whose mass above t
    is the chance of at most m successes in n + 1 trials of chance t.
    """
    below = 0.0
    for m in range(compared + 1):
        below += comb(compared + 1, m) * threshold**m * (1 - threshold) ** (compared + 1 - m)
        if below >= tolerance:
            return m
    return compared


def surviving(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of two signature matrices that incremental comparison does not drop."""
    same = np.zeros((len(a), len(b)), np.int16)
    for k in range(STEP):
        same += a[:, k, None] == b[None, :, k]
    x, y = np.nonzero(same >= fewest_matches(STEP))
    same = same[x, y]
    for first in range(STEP, HASHES, STEP):
        same = same + (a[x, first:first + STEP] == b[y, first:first + STEP]).sum(1, dtype=np.int16)
        alive = same >= fewest_matches(first + STEP)
        x, y, same = x[alive], y[alive], same[alive]
    return x, y


def overlaps(a: list[np.ndarray], b: list[np.ndarray], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact sizes of the intersections of the sets ``a[x]`` and ``b[y]``."""
    if len(x) <= 4 * (len(a) + len(b)):
        return np.array([len(np.intersect1d(a[i], b[j], assume_unique=True)) for i, j in zip(x, y, strict=True)], np.int64)
    # Many pairs: membership matrices over the n-grams both sides have, multiplied part by part.
    ours, theirs = np.concatenate(a), np.concatenate(b)
    known = np.intersect1d(ours, theirs)
    row_a, row_b = np.repeat(np.arange(len(a)), list(map(len, a))), np.repeat(np.arange(len(b)), list(map(len, b)))
    total = np.zeros((len(a), len(b)), np.float64)
    for first in range(0, len(known), CHUNK):
        part = known[first:first + CHUNK]
        matrices = []
        for values, rows, n in ((ours, row_a, len(a)), (theirs, row_b, len(b))):
            at = np.minimum(np.searchsorted(part, values), len(part) - 1)
            hit = part[at] == values
            m = np.zeros((n, len(part)), np.float32)
            m[rows[hit], at[hit]] = 1
            matrices.append(m)
        total += matrices[0] @ matrices[1].T
    return total[x, y].astype(np.int64)


def linked(family: pd.DataFrame) -> pd.DataFrame:
    """Links found between the two blocks of a family: per node, a root of its class and its links."""
    family = family.drop_duplicates(["node", "side"])
    low, high = int(family["low"].iloc[0]), int(family["high"].iloc[0])
    sides = [family[family["side"] == s] for s in ((low, low) if low == high else (low, high))]
    nodes = [s["node"].to_numpy() for s in sides]
    weights = [s["copies"].to_numpy() for s in sides]
    marks = [np.frombuffer(b"".join(s["signature"]), np.uint32).reshape(-1, HASHES) for s in sides]
    grams = [[np.frombuffer(g, U64) for g in s["grams"]] for s in sides]
    sizes = [np.array(list(map(len, g)), np.int64) for g in grams]
    empty = pd.DataFrame({c: np.empty(0, np.int64) for c in ("node", "root", "links")})
    if not len(nodes[0]) or not len(nodes[1]):
        return empty
    x, y = surviving(*marks)
    if low == high:
        x, y = x[x < y], y[x < y]
    both = overlaps(*grams, x, y)
    # both / (|a| + |b| - both) >= 4/5, in whole numbers.
    real = both * 9 >= 4 * (sizes[0][x] + sizes[1][y])
    x, y = x[real], y[real]
    if not len(x):
        return empty
    links: dict[int, int] = {}
    roots: dict[int, int] = {}

    def root(n: int) -> int:
        while roots.setdefault(n, n) != n:
            roots[n] = roots[roots[n]]
            n = roots[n]
        return n

    for i, own, other, weight in ((x, nodes[0], y, weights[1]), (y, nodes[1], x, weights[0])):
        sums = np.bincount(i, weight[other], len(own)).astype(np.int64)
        for at in np.flatnonzero(sums):
            links[int(own[at])] = links.get(int(own[at]), 0) + int(sums[at])
    for i, j in zip(nodes[0][x].tolist(), nodes[1][y].tolist(), strict=True):
        i, j = root(i), root(j)
        if i != j:
            roots[max(i, j)] = min(i, j)
    return pd.DataFrame({"node": list(links), "root": [root(n) for n in links], "links": list(links.values())})


def joined(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """One row per input row: doc_id, class_id, n_links, class_size, stays, text_key (a hash of the text).

    Rows are linked if the Jaccard similarity of their sets of 5-word n-grams is 0.8 or more; words are runs of
    other characters than white space, unchanged. A text of one to four words has one n-gram. ``n_links``
    counts the other rows linked to a row, copies too. Classes are the connected components of links;
    ``class_id`` is the smallest doc_id of a class (a NULL id comes last), and the row that has it
    ``stays``, the first of those that repeat it. Texts without a word, NULL ones too, are linked
    to nothing: each is a class of its own. An empty table gives an empty result.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    texts = rows.withColumn("text_key", F.xxhash64("text"))
    nodes = staged(
        texts.withColumn("row", F.monotonically_increasing_id()).mapInArrow(_nodes, NODES), "nodes")
    name = ["set_1", "set_2"]
    wordless = F.size("bands") == 0
    sets = staged(
        nodes.filter(~wordless).groupBy(*name).agg(
            F.min("row").alias("node"), F.count(F.lit(1)).alias("copies")), "sets")
    heads = nodes.join(sets.select(*name, F.col("node").alias("row")), [*name, "row"]).select(
        F.col("row").alias("node"), "doc_id", "text_key", *name, "bands")
    keys = heads.select("node", F.explode("bands").alias("band"))
    leaders = keys.groupBy("band").agg(F.min("node").alias("leader"), F.max("node").alias("last")).filter("leader < last")
    edges = split_join(keys, leaders, ["band"]).filter("node <> leader").select(F.col("node").alias("a"), F.col("leader").alias("b")).distinct()
    families = components(edges)

    sizes = families.groupBy("component").agg(F.count(F.lit(1)).alias("n"))
    members = staged(
        families.join(sizes, "component").join(sets, "node")
        .withColumn("blocks", F.ceil(F.col("n") / block).cast("long"))
        .withColumn("side", F.pmod(F.xxhash64("node"), "blocks"))
        .join(heads.select("node", "doc_id", "text_key"), "node")
        .select("component", "node", "copies", "blocks", "side", "doc_id", "text_key", *name), "members")
    key = ["doc_id", "text_key"]
    asked = members.select(*key).distinct()
    # An inner join: a semi join would be moved below the bit set, and all texts would be shuffled.
    wanted = asked.select(F.col("doc_id").alias("d"), F.col("text_key").alias("t"))
    content = (
        maybe_in(texts, asked, *key)
        .join(wanted, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_key") == F.col("t")))
        .select("text").mapInArrow(_sets, SETS)
    )
    met = (
        members.join(content, name)
        .withColumn("other", F.explode(F.expr("sequence(0L, blocks - 1)")))
        .select("component", "node", "copies", "side", F.least("side", "other").alias("low"),
                F.greatest("side", "other").alias("high"), "signature", "grams")
    )
    found = staged(met.groupBy("component", "low", "high").applyInPandas(linked, FOUND), "found")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    classes = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))

    of_set = (
        sets.join(links, "node", "left").join(classes, "node", "left")
        .select(*name, (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                F.coalesce("component", "node").alias("class"))
    )
    each = staged(
        nodes.drop("bands").join(of_set, name, "left")
        .select("row", "doc_id", "text_key", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                F.coalesce("class", "row").alias("class")), "classes")
    best = each.groupBy("class").agg(
        F.min(F.struct(F.isnull("doc_id").alias("none"), "doc_id", "row")).alias("best"), F.count(F.lit(1)).alias("class_size"))
    return split_join(each, best, ["class"]).select(
        "doc_id", F.col("best.doc_id").alias("class_id"), "n_links", "class_size",
        (F.col("row") == F.col("best.row")).alias("stays"), "text_key")


def one_of_each_class(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with their columns."""
    found = joined(docs, id_col, text_col).select("doc_id", "text_key", "stays")
    return staying(docs, found, F.col(id_col), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))))
