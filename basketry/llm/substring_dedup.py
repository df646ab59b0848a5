"""Removal of passages that occurred before (operator 9), by Rabin-Karp hashes of word windows.

Every window of ``WINDOW`` words has a rolling hash of 128 bits; a window is repeated if its hash
belongs to several documents. To count only where a repeat is possible, texts are first compared by
anchors: of the ``WINDOW - GRAM + 1`` shorter windows in a window, the one with the smallest
hash. Equal windows have equal anchors, so a window without an anchor that another document has is
not repeated; about one window in eighteen is an anchor. Texts equal as a whole are settled before,
as every window of a later copy is in the first.

Hashes are counted with map-side aggregation and joined back by joins that split skewed keys, so a
passage that a third of the documents share makes no task large. Texts move only where a document
shares an anchor.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.shared import maybe_in, split_join, staged
from basketry.llm.words import U64, hashed, mixed, rolled, slices, split

WINDOW, GRAM = 50, 16
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
LAST = 2**63 - 1

FACTS = ("doc_id long, rank long, text_key long, seq_1 long, seq_2 long, n_words long, sha string, "
         "anchors array<long>, places array<int>")
WINDOWS = "rank long, text_key long, start int, hash_1 long, hash_2 long"
KEPT = "rank long, text_key long, n_removed long, sha string"


def anchor_places(grams: np.ndarray, span: int) -> np.ndarray:
    """Places of the smallest (leftmost) value of every ``span`` consecutive ones."""
    if len(grams) < span:
        return np.empty(0, np.int64)
    windows = np.lib.stride_tricks.sliding_window_view(grams, span)
    return np.unique(np.arange(len(windows)) + windows.argmin(1))


def window_starts(places: np.ndarray, n_words: int, window: int, gram: int) -> np.ndarray:
    """Starts of the windows of a text of ``n_words`` that hold a gram at one of ``places``."""
    near = (np.unique(places)[:, None] - np.arange(window - gram + 1)).ravel()
    return np.unique(near[(near >= 0) & (near <= n_words - window)])


def removed(starts: np.ndarray, n_words: int, window: int) -> list[tuple[int, int]]:
    """Maximal intervals [first, last) of words that windows at ``starts`` cover."""
    starts = np.unique(starts)
    cut = np.flatnonzero(np.diff(starts) > window) + 1
    return [(int(r[0]), min(int(r[-1]) + window, n_words)) for r in np.split(starts, cut) if len(r)]


def kept_words(text: str, spans: list[tuple[int, int]]) -> list[bytes]:
    words = text.encode().split()
    for first, last in reversed(spans):
        del words[first:last]
    return words


def sha256(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def _signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def _facts(window: int, gram: int):
    def facts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                distinct, index, starts = split(batch.column("text"))
                one, two = hashed(distinct)[index], hashed(distinct, 1)[index]
                seq, anchors, places, shas = [], [], [], []
                for row, text in enumerate(batch.column("text").to_pylist()):
                    a, b = one[starts[row]:starts[row + 1]], two[starts[row]:starts[row + 1]]
                    # The whole text is one window; its hash is that of its words' hashes in order.
                    seq.append([int.from_bytes(hashlib.blake2b(w.tobytes(), digest_size=8).digest(), "little", signed=True)
                                for w in (a, b)])
                    grams = mixed(rolled(a, gram, BASES[0])) if len(a) >= window else np.empty(0, U64)
                    at = anchor_places(grams, window - gram + 1)
                    anchors.append(_signed(grams[at]))
                    places.append(at.astype(np.int32))
                    shas.append(sha256(text.encode().split()))
                offsets = pa.array(np.cumsum([0, *map(len, anchors)]), pa.int32())
                both = np.array(seq, np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c) for c in ("doc_id", "rank", "text_key")), pa.array(both[:, 0]), pa.array(both[:, 1]),
                     pa.array(np.diff(starts), pa.int64()), pa.array(shas, pa.string()),
                     pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(anchors), pa.int64())),
                     pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(places), pa.int32()))],
                    [c.split()[0] for c in FACTS.split(", ")])
    return facts


def _windows(window: int, gram: int):
    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                distinct, index, starts = split(batch.column("text"))
                one, two = hashed(distinct)[index], hashed(distinct, 1)[index]
                for row in range(batch.num_rows):
                    a, b = one[starts[row]:starts[row + 1]], two[starts[row]:starts[row + 1]]
                    at = window_starts(batch.column("places")[row].values.to_numpy(), len(a), window, gram)
                    yield pa.RecordBatch.from_arrays(
                        [pa.repeat(batch.column("rank")[row], len(at)), pa.repeat(batch.column("text_key")[row], len(at)),
                         pa.array(at, pa.int32()), pa.array(_signed(mixed(rolled(a, window, BASES[0]))[at])),
                         pa.array(_signed(mixed(rolled(b, window, BASES[1]))[at]))],
                        [c.split()[0] for c in WINDOWS.split(", ")])
    return windows


def _cut(window: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                rows = []
                for row, text in enumerate(batch.column("text").to_pylist()):
                    n = len(text.encode().split())
                    spans = removed(batch.column("starts")[row].values.to_numpy(), n, window)
                    rows.append((sum(last - first for first, last in spans), sha256(kept_words(text, spans))))
                n, sha = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("rank"), batch.column("text_key"), pa.array(n, pa.int64()), pa.array(sha, pa.string())],
                    [c.split()[0] for c in KEPT.split(", ")])
    return cut


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256.

    A word is removed if a window over it also starts in a document with a smaller id; windows are
    judged on the input. A NULL text has no words, and a text shorter than a window loses none. A
    NULL id counts as greater than all others; rows that share an id don't remove each
    other's words. An empty table gives an empty result; other columns are ignored.
    """
    key = ["rank", "text_key"]
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)).alias("rank"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn("text_key", F.xxhash64("text"))
    facts = staged(rows.select("doc_id", *key, "text").mapInArrow(_facts(window, gram), FACTS), "facts")

    whole = ["seq_1", "seq_2"]
    repeated = facts.groupBy(*whole).agg(F.min("rank").alias("first"), F.max("rank").alias("last")).filter(
        "first < last").select(*whole, "first")
    marked = staged(
        split_join(facts, repeated, whole, "left").withColumn("copy", F.coalesce(F.col("rank") > F.col("first"), F.lit(False)))
        .drop("first", *whole), "marked")

    anchors = marked.filter("not copy").select(
        *key, F.explode(F.arrays_zip("anchors", "places")).alias("a")).select(
        *key, F.col("a.anchors").alias("anchor"), F.col("a.places").alias("place"))
    spread = anchors.groupBy("anchor").agg(F.min("rank").alias("low"), F.max("rank").alias("high")).filter(
        "low < high").select("anchor")
    shared = staged(split_join(anchors, spread, ["anchor"]).groupBy(*key).agg(F.collect_list("place").alias("places")), "shared")

    texts = rows.select(*key, "text")
    windows = staged(maybe_in(texts, shared, *key).join(shared, key).select(*key, "text", "places").mapInArrow(
        _windows(window, gram), WINDOWS), "windows")
    name = ["hash_1", "hash_2"]
    first = windows.groupBy(*name).agg(F.min("rank").alias("low"), F.max("rank").alias("high")).filter(
        "low < high").select(*name, "low")
    hits = staged(split_join(windows, first, name).filter("rank > low").groupBy(*key).agg(
        F.collect_list("start").alias("starts")), "hits")

    cut = maybe_in(texts, hits, *key).join(hits, key).select(*key, "text", "starts").mapInArrow(
        _cut(window), KEPT).dropDuplicates(key).withColumnRenamed("sha", "kept")
    gone = F.col("copy") & (F.col("n_words") >= window)
    return marked.drop("anchors", "places").join(cut, key, "left").select(
        "doc_id", "n_words",
        F.when(gone, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(gone, F.lit(sha256([]))).otherwise(F.coalesce("kept", "sha")).alias("kept_sha256"))
