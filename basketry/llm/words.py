"""Words and their hashes, a batch of texts at a time.

A word is a run of bytes other than space and the control characters 9 to 13. Splitting and
dictionary encoding run on Arrow arrays; Python sees each distinct word of a batch once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

#: A word, as a pattern for Spark's and Python's regular expressions.
WORD = r"[^\x20\x09-\x0D]+"

#: Text bytes a task holds at once, beside one whole text that is longer.
SLICE_BYTES = 4 << 20

U64 = np.uint64


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of ``batch`` with at most ``limit`` bytes of ``column`` each, or one row."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for row, size in enumerate(sizes):
        if row > start and held + size > limit:
            yield batch.slice(start, row - start)
            start, held = row, 0
        held += int(size)
    if start < batch.num_rows:
        yield batch.slice(start)


def split(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(distinct words, index of each word among them, where each text's words start; one more)."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    values = lists.flatten().dictionary_encode()
    distinct = values.dictionary.to_pylist()
    index = values.indices.to_numpy(zero_copy_only=False)
    counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    starts = np.concatenate([[0], np.cumsum(counts)])
    if "" in distinct:  # stands before leading and after trailing white space
        real = index != distinct.index("")
        starts = np.concatenate([[0], np.cumsum(real)])[starts]
        index = index[real]
    return distinct, index, starts


def hashed(distinct: list[str], seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each word."""
    digest = xxhash.xxh3_64_intdigest
    return np.fromiter((digest(w.encode(), seed) for w in distinct), U64, len(distinct))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that leaves no linear structure (the finisher of splitmix64)."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def rolled(words: np.ndarray, length: int, base: int) -> np.ndarray:
    """Rabin-Karp hashes modulo 2^64 of all windows of ``length`` consecutive values.

    Window i is the sum of ``words[i + k] * base ** (length - 1 - k)``, built by doubling: a window
    of 2n values is two neighbouring windows of n, so it takes about 2 log2(length) passes.
    """
    if len(words) < length:
        return np.empty(0, U64)
    done, power, total = words, base, 1
    for bit in bin(length)[3:]:
        done = done[:-total] * U64(power) + done[total:]
        power, total = power * power % 2**64, total * 2
        if bit == "1":
            done = done[:-1] * U64(base) + words[total:total + len(done) - 1]
            power, total = power * base % 2**64, total + 1
    return done
