"""Web archives without repeated payloads (operator 2).

Headers (id, address, payload digest, size) are shuffled by digest, and the smallest id of each
digest becomes the response; the other records of the digest are revisits that refer to it. Only
then do the payloads of responses and the headers of revisits go to the archives, each record with
fresh headers in a gzip member of its own. Reading parses the archives, checks each payload against
its digest, and joins revisits to the responses they refer to.

Payloads are shuffled once, by record id, so a payload that a third of the records share makes no
task large: revisits carry no payload.
"""

from __future__ import annotations

import base64
import datetime
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm import files
from basketry.llm.shared import scratch_folder, split_join, staged

#: A file is closed once it holds this much.
FILE_BYTES = 256 << 20
#: Fixed values of the format.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # of names that are URLs

MANIFEST = "path string, records long"
RECORD = ("record_id string, page_id long, uri string, record_type string, payload_bytes long, "
          "payload_digest string, refers_id string, payload binary")


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _clean(uri: str | None) -> str:
    """An address fit for a header line: what is not printable ASCII is percent-encoded."""
    return "".join(chr(b) if 33 <= b <= 126 else f"%{b:02X}" for b in (uri or "").encode())


def record(kind: str, name: str, page_id: int | None, uri: str | None, date: str, digest: str,
           size: int, payload: bytes, refers: str | None) -> bytes:
    """One record in one gzip member; a revisit's block has HTTP headers only."""
    block = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
             f"Content-Length: {size}\r\n\r\n").encode() + payload
    head = [VERSION, f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:uuid:{name}>", f"WARC-Date: {date}",
            f"WARC-Target-URI: {_clean(uri)}", f"WARC-Payload-Digest: sha1:{digest}",
            f"WARC-Block-Digest: sha1:{digest_of(block)}"]
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if refers:
        head += [f"WARC-Refers-To: <urn:uuid:{refers}>", f"WARC-Profile: {PROFILE}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    member = zlib.compressobj(6, wbits=31)
    return member.compress("\r\n".join(head).encode() + block + b"\r\n\r\n") + member.flush()


def members(stream, chunk: int = 1 << 20) -> Iterator[bytes]:
    """The contents of the gzip members of a stream, one after another."""
    data, at_end = b"", False
    while True:
        if not data:
            data = stream.read(chunk)
            if not data:
                return
        unzip, parts = zlib.decompressobj(wbits=31), []
        while not unzip.eof:
            if not data:
                data = stream.read(chunk)
                if not data:
                    raise ValueError("archive ends within a record")
            parts.append(unzip.decompress(data))
            data = unzip.unused_data
        yield b"".join(parts)


def parsed(content: bytes) -> dict:
    """Fields of a record; the payload of a response is checked against length and digest."""
    head, _, rest = content.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != VERSION:
        raise ValueError(f"not a {VERSION} record: {lines[0][:80]}")
    named = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[:int(named["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(http.rpartition(b"Content-Length: ")[2])
    digest = named["WARC-Payload-Digest"].removeprefix("sha1:")
    kind = named["WARC-Type"]
    if kind == "response" and (len(payload) != size or digest_of(payload) != digest):
        raise ValueError(f"payload of {named['WARC-Record-ID']} is damaged")
    bare = lambda name: named[name][10:-1] if name in named else None
    page = named.get("X-Page-ID")
    return {"record_id": bare("WARC-Record-ID"), "page_id": None if page is None else int(page),
            "uri": named["WARC-Target-URI"], "record_type": kind, "payload_bytes": size,
            "payload_digest": digest, "refers_id": bare("WARC-Refers-To"), "payload": payload}


def resolved(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
             payload_col: str = "html", least: int = 0) -> DataFrame:
    """Rows to archive: page_id, url, copy, sha1, first, record_type, size, payload.

    ``first`` is the id of the response of equal payloads of ``least`` bytes or more, which has
    ``copy`` 1; of rows that agree in id and payload, the others get larger numbers, with gaps. A
    revisit has no payload. All this is settled on headers; a payload is moved once per map task that
    holds it, however many rows repeat it.
    """
    key = ["none", "known", "sha1"]
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"),
        F.coalesce(F.col(payload_col), F.lit("")).cast("binary").alias("body"),
    ).select("*", F.isnull("page_id").alias("none"), F.coalesce("page_id", F.lit(0)).alias("known"),
             F.sha1("body").alias("sha1"))
    headers = staged(rows.select(F.monotonically_increasing_id().alias("row"), "page_id", "url", *key,
                                 F.octet_length("body").cast("long").alias("size")), "headers")
    first = (
        headers.filter(F.col("size") >= least).groupBy("sha1")
        .agg(F.min(F.struct("none", "known")).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    )
    alike = (
        headers.groupBy(*key).agg(F.min(F.struct("url", "row")).alias("leads"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1").select(*key, "leads")
    )
    own = (F.col("first.none") == F.col("none")) & (F.col("first.known") == F.col("known"))
    copy = F.when(F.isnull("leads") | (F.col("leads.row") == F.col("row")), F.lit(1)).otherwise(F.col("row") + 2)
    roles = staged(
        split_join(split_join(headers, alike, key, "left").withColumn("copy", copy.cast("long")),
                   first.select("sha1", "first"), ["sha1"], "left")
        .withColumn("record_type", F.when(F.isnull("first") | (own & (F.col("copy") == 1)), "response")
                    .otherwise("revisit"))
        .select("page_id", "url", "copy", "sha1", F.isnotnull("first").alias("shared"),
                F.when(~F.col("first.none"), F.col("first.known")).alias("first"), "record_type", "size"), "roles")
    bodies = rows.groupBy("sha1").agg(F.first("body").alias("payload"))
    asked = roles.filter("record_type = 'response'")
    # Below ``least`` bytes every row is a response, so such a payload may be asked for by very many.
    responses = split_join(asked, bodies, ["sha1"]) if least > 0 else asked.join(bodies, "sha1")
    revisits = roles.filter("record_type = 'revisit'").withColumn("payload", F.lit(None).cast("binary"))
    return responses.unionByName(revisits)


def _name(page_id: int | None, sha1: str, copy: int) -> str:
    """The record id: the same for the same page in every run."""
    return str(uuid.uuid5(SPACE, f"urn:page:{page_id}:{sha1}:{copy}"))


def write_archives(rows: DataFrame, folder: str, date: str | None = None,
                   file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write the rows of ``resolved`` to archives in ``folder``; the manifest (path, records)."""
    date = date or datetime.datetime.now(datetime.UTC).strftime("%Y-%m-%dT%H:%M:%SZ")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, path, count, held = None, "", 0, 0
        written: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                digest = base64.b32encode(bytes.fromhex(row["sha1"])).decode()
                revisit = row["record_type"] == "revisit"
                data = record(
                    row["record_type"], _name(row["page_id"], row["sha1"], row["copy"]), row["page_id"],
                    row["url"], date, digest, row["size"], row["payload"] or b"",
                    _name(row["first"], row["sha1"], 1) if revisit else None)
                if out is None:
                    path, count, held = files.new_name(folder, ".warc.gz"), 0, 0
                    out = files.create(path)
                out.write(data)
                count, held = count + 1, held + len(data)
                if held >= file_bytes:
                    out.close()
                    out = None
                    written.append({"path": path, "records": count})
        if out is not None:
            out.close()
            written.append({"path": path, "records": count})
        yield pa.RecordBatch.from_pylist(written, pa.schema([("path", pa.string()), ("records", pa.int64())]))

    columns = ["page_id", "url", "copy", "sha1", "first", "record_type", "size", "payload"]
    return staged(rows.select(columns).mapInArrow(write, MANIFEST), "manifest")


def read_archives(manifest: DataFrame, payloads: bool = True) -> DataFrame:
    """The records of the archives in a manifest; each file is streamed by one task."""
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    schema = pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in RECORD.split(", ")])

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                found, held = 0, []
                with files.read(row["path"]) as stream:
                    for content in members(stream):
                        one = parsed(content)
                        if not payloads:
                            one["payload"] = None
                        held.append(one)
                        found += 1
                        if len(held) >= (64 if payloads else 4096):
                            yield pa.RecordBatch.from_pylist(held, schema)
                            held = []
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema)
                if found != row["records"]:
                    raise ValueError(f"{row['path']} has {found} records, not {row['records']}")

    spread = manifest.repartitionByRange(max(1, manifest.count()), "path")
    return spread.mapInArrow(parse, RECORD)


def archived_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
                   payload_col: str = "html", least: int = 0) -> DataFrame:
    """Write ``pages`` as deduplicated archives and read them back.

    Returns page_id, payload_bytes, payload_digest (base32 SHA-1), record_type and refers_to (the
    page of the response, for revisits). Of equal payloads of ``least`` bytes or more the row with
    the smallest id is the response (a NULL id comes last, and a revisit of a response without id
    has no refers_to), even if rows repeat. A NULL payload is empty; a NULL address is written as an
    empty one. An empty table gives no archive and an empty result.
    """
    spark = pages.sparkSession
    rows = resolved(pages, id_col, url_col, payload_col, least)
    manifest = write_archives(rows, scratch_folder(spark, "archives"))
    records = staged(read_archives(manifest, payloads=False).drop("payload", "uri"), "records")
    responses = records.filter("record_type = 'response'").select(
        F.col("record_id").alias("refers_id"), F.col("page_id").alias("refers_to"))
    return records.join(responses, "refers_id", "left").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
