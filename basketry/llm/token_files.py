"""Files of token ids, compressed document by document with a shared dictionary (operator 7).

A zstandard dictionary is trained on the serialised ids of a bounded sample. Documents are sorted by
id over all partitions; each task encodes its own, compresses each on its own with the dictionary,
and writes files:

    "TOKZ", version, bytes per id, two zero bytes, SHA-256 of the dictionary
    one zstandard frame per document
    index: ids of the documents, which have one, offsets of the frames (one more), numbers of ids
    place of the index, number of documents, CRC-32 of the index, "TOKZ"

All numbers are little-endian. The index lets a reader fetch one short document by its offset. The
manifest, a Spark table, names the files in order with the number of ids before each.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm import files
from basketry.llm.shared import scratch_folder, staged
from basketry.llm.tokens import encoder
from basketry.llm.words import slices

MAGIC, VERSION = b"TOKZ", 1
FOOT = struct.Struct("<QQI4s")
HEAD_BYTES = 40
END_ID = 2
FILE_BYTES = 128 << 20
DICTIONARY_BYTES = 64 << 10
#: The dictionary's sample: so many documents, chosen by hash, of up to so many ids each.
SAMPLE_DOCS, SAMPLE_IDS = 2000, 16_384
LEVEL = 3
#: Text bytes encoded at once: the more, the fewer words are looked up again.
SLICE_BYTES = 8 << 20

MANIFEST = "part long, place long, path string, docs long, ids long"
READ = "doc_id long, start long, n_tokens long, ids_crc32 long"


def serialised(ids: np.ndarray, width: int, end: int | None = END_ID) -> bytes:
    out = np.empty(len(ids) + (end is not None), f"<u{width}")
    out[:len(ids)] = ids
    if end is not None:
        out[-1] = end
    return out.tobytes()


def trained(samples: list[bytes]) -> bytes:
    """Dictionary bytes; where the samples are too few to train on, their own content serves."""
    samples = [s for s in samples if s]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICTIONARY_BYTES:]


def _dictionary(content: bytes) -> zstandard.ZstdCompressionDict:
    return zstandard.ZstdCompressionDict(content)


def train(docs: DataFrame, path: str, spaced: bool, width: int) -> bytes:
    chosen = (
        docs.select("doc_id").filter("doc_id is not null")
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_DOCS).distinct()
    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                ids = encoder(path, spaced).encode(batch.column("text"))
                short = [serialised(i, width) for i in ids if len(i) < SAMPLE_IDS]
                yield pa.RecordBatch.from_arrays([pa.array(short, pa.binary())], ["sample"])

    rows = docs.join(F.broadcast(chosen), "doc_id").select("text").mapInArrow(encode, "sample binary")
    return trained(sorted(bytes(r["sample"]) for r in rows.limit(SAMPLE_DOCS).toLocalIterator()))


class Writer:
    """Writes documents one by one to a new file."""

    def __init__(self, folder: str, width: int, content: bytes) -> None:
        self.path = files.new_name(folder, ".tokz")
        self.out = files.create(self.path)
        digest = hashlib.sha256(content).digest()
        self.out.write(MAGIC + bytes([VERSION, width, 0, 0]) + digest)
        self.at, self.total = HEAD_BYTES, 0
        self.ids: list[int | None] = []
        self.offsets, self.counts = [HEAD_BYTES], []

    def add(self, doc_id: int | None, frame: bytes, count: int) -> None:
        self.out.write(frame)
        self.at += len(frame)
        self.total += count
        self.ids.append(doc_id)
        self.offsets.append(self.at)
        self.counts.append(count)

    def close(self) -> None:
        known = np.array([i is not None for i in self.ids], np.uint8)
        index = b"".join([np.array([i or 0 for i in self.ids], "<i8").tobytes(), known.tobytes(),
                          np.array(self.offsets, "<u8").tobytes(), np.array(self.counts, "<u8").tobytes()])
        self.out.write(index + FOOT.pack(self.at, len(self.ids), zlib.crc32(index), MAGIC))
        self.out.close()


class Reader:
    """Random access to the documents of a file."""

    def __init__(self, path: str, content: bytes) -> None:
        self.file = files.seekable(path)
        head = self.file.read_at(HEAD_BYTES, 0)
        if head[:4] != MAGIC or head[4] != VERSION:
            raise ValueError(f"{path} is not a token file")
        if head[8:] != hashlib.sha256(content).digest():
            raise ValueError(f"{path} was written with another dictionary")
        self.width = head[5]
        size = self.file.size()
        at, n, crc, magic = FOOT.unpack(self.file.read_at(FOOT.size, size - FOOT.size))
        index = self.file.read_at(size - FOOT.size - at, at)
        if magic != MAGIC or zlib.crc32(index) != crc:
            raise ValueError(f"{path} is damaged")
        self.ids = np.frombuffer(index, "<i8", n)
        self.known = np.frombuffer(index, np.uint8, n, 8 * n)
        self.offsets = np.frombuffer(index, "<u8", n + 1, 9 * n)
        self.counts = np.frombuffer(index, "<u8", n, 17 * n + 8)
        self.unzip = zstandard.ZstdDecompressor(dict_data=_dictionary(content))

    def __len__(self) -> int:
        return len(self.ids)

    def document(self, place: int) -> np.ndarray:
        start, stop = int(self.offsets[place]), int(self.offsets[place + 1])
        raw = self.unzip.decompress(self.file.read_at(stop - start, start))
        return np.frombuffer(raw, f"<u{self.width}")

    def find(self, doc_id: int) -> np.ndarray | None:
        """The ids of one document, without reading the others."""
        at = np.flatnonzero((self.ids == doc_id) & (self.known == 1))
        return self.document(int(at[0])) if len(at) else None


def write_token_files(docs: DataFrame, folder: str, path: str, spaced: bool, width: int,
                      content: bytes, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write (doc_id, text) in ascending doc_id order; the manifest with ``start`` of each file."""
    shared = docs.sparkSession.sparkContext.broadcast(content)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, done = TaskContext.get().partitionId(), []
        zip_ = zstandard.ZstdCompressor(level=LEVEL, dict_data=_dictionary(shared.value))
        out: Writer | None = None

        def close() -> None:
            out.close()
            done.append({"part": part, "place": len(done), "path": out.path, "docs": len(out.ids), "ids": out.total})

        for whole in batches:
            for batch in slices(whole, "text", SLICE_BYTES):
                ids = encoder(path, spaced).encode(batch.column("text"))
                for doc_id, own in zip(batch.column("doc_id").to_pylist(), ids, strict=True):
                    out = out or Writer(folder, width, shared.value)
                    out.add(doc_id, zip_.compress(serialised(own, width)), len(own) + 1)
                    if out.at >= file_bytes:
                        close()
                        out = None
        if out:
            close()
        kinds = [("part", pa.int64()), ("place", pa.int64()), ("path", pa.string()), ("docs", pa.int64()), ("ids", pa.int64())]
        yield pa.RecordBatch.from_pylist(done, pa.schema(kinds))

    # The number of a row splits rows that agree in id and text among tasks.
    order = [F.asc_nulls_first("doc_id"), F.xxhash64("text"), F.col("row")]
    written = staged(
        docs.select("doc_id", "text", F.monotonically_increasing_id().alias("row")).repartitionByRange(*order).sortWithinPartitions(*order)
        .mapInArrow(write, MANIFEST), "token-files")
    # One row per file: few enough for one task.
    before = Window.orderBy("part", "place").rowsBetween(Window.unboundedPreceding, -1)
    return staged(written.withColumn("start", F.coalesce(F.sum("ids").over(before), F.lit(0))), "manifest")


def read_token_files(manifest: DataFrame, content: bytes) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document of the files of a manifest."""
    shared = manifest.sparkSession.sparkContext.broadcast(content)
    kinds = pa.schema([(c.split()[0], pa.int64()) for c in READ.split(", ")])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                reader, start, found = Reader(row["path"], shared.value), row["start"], []
                if len(reader) != row["docs"]:
                    raise ValueError(f"{row['path']} has {len(reader)} documents, not {row['docs']}")
                for place in range(len(reader)):
                    ids = reader.document(place)
                    if len(ids) != reader.counts[place]:
                        raise ValueError(f"{row['path']}: document {place} is damaged")
                    found.append({
                        "doc_id": int(reader.ids[place]) if reader.known[place] else None, "start": start,
                        "n_tokens": len(ids), "ids_crc32": zlib.crc32(ids.astype("<u4"))})
                    start += len(ids)
                    if len(found) == 4096:
                        yield pa.RecordBatch.from_pylist(found, kinds)
                        found = []
                if found:
                    yield pa.RecordBatch.from_pylist(found, kinds)

    spread = manifest.select("path", "docs", "start").repartitionByRange(max(1, manifest.count()), "start")
    return spread.mapInArrow(scan, READ)


@lru_cache
def vocabulary_width(path: str) -> int:
    """Bytes that hold any id of a vocabulary."""
    from tokenizers import Tokenizer

    return 2 if Tokenizer.from_file(path).get_vocab_size() <= 1 << 16 else 4


def token_digests(docs: DataFrame, path: str, spaced: bool = True, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """Write the ids of all texts to files, in ascending id order, and read the files back.

    Returns doc_id, start (ids of all documents before it), n_tokens (with the end id) and ids_crc32.
    A NULL or empty text has the end id alone. A NULL doc_id comes first; rows that repeat an id
    stand side by side in the order of a hash of their texts. An empty table gives an empty result.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    width = vocabulary_width(path)
    content = train(rows, path, spaced, width)
    folder = scratch_folder(docs.sparkSession, "tokens")
    return read_token_files(write_token_files(rows, folder, path, spaced, width, content), content)
