"""Web archives (WARC 1.1) of individually compressed records.

Each archive starts with a skippable frame that holds a Zstandard dictionary
built from the archive's own records; every record is one frame compressed
with it, so records can be read one by one.  Archives are rows (path,
content), the columns of Spark's ``binaryFile`` source: ``read_archives``
takes either.  A record whose payload another one has is a revisit of it.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabmeter.llm.tables import written

DICTIONARY_MAGIC = 0x184D2A5D
DICTIONARY_BYTES = 1 << 16
ARCHIVE_BYTES = 8 << 20
SAMPLE_BYTES = 2 << 20
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORDS = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record_id(page_id: int | None, digest: str, url: str) -> str:
    name = f"page:{page_id}" if page_id is not None else f"{url} {digest}"
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>"


def build_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str) -> bytes:
    """One WARC record: a response, or a revisit of page ``refers_to``.

    The HTTP header gives the payload's full length in both; control
    characters and spaces of a url are percent-encoded, and a null url is
    left out."""
    digest = payload_digest(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    safe = None if url is None else re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)
    head = [("WARC-Type", "response" if refers_to is None else "revisit"),
            ("WARC-Record-ID", _record_id(page_id, digest, safe or "")), ("WARC-Date", date)]
    if safe is not None:
        head.append(("WARC-Target-URI", safe))
    if page_id is not None:
        head.append(("X-Page-ID", str(page_id)))
    if refers_to is not None:
        head += [("WARC-Profile", REVISIT), ("WARC-Refers-To", _record_id(refers_to, digest, "")), ("X-Refers-To-Page", str(refers_to))]
    head += [("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type", "application/http; msgtype=response"),
             ("Content-Length", str(len(block)))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + block + b"\r\n\r\n"


def parse_record(record: bytes) -> tuple:
    """The columns of RECORDS; raises ValueError if a payload does not have
    the digest that its record states."""
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = int(re.search(rb"Content-Length: ([0-9]+)", http)[1])
    digest, kind = fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields["WARC-Type"]
    if kind == "response" and (len(payload) != length or payload_digest(payload) != digest):
        raise ValueError(f"payload of {fields['WARC-Record-ID']} does not match its digest")
    number = lambda k: int(fields[k]) if k in fields else None
    return (number("X-Page-ID"), fields.get("WARC-Target-URI"), length, digest, kind, number("X-Refers-To-Page"),
            payload if kind == "response" else None)


def build_archive(records: list[bytes], level: int = 3) -> bytes:
    """A dictionary frame and one frame for each record."""
    import zstandard

    samples, size = [], 0
    for r in records:
        if size >= SAMPLE_BYTES:
            break
        samples.append(r)
        size += len(r)
    try:
        raw = zstandard.train_dictionary(DICTIONARY_BYTES, samples, k=256, d=8).as_bytes()
    except zstandard.ZstdError:  # too few records to train on: their own bytes serve
        raw = b"".join(samples)[:DICTIONARY_BYTES]
    pack = zstandard.ZstdCompressor(level=level, dict_data=zstandard.ZstdCompressionDict(raw), write_checksum=True)
    return struct.pack("<II", DICTIONARY_MAGIC, len(raw)) + raw + b"".join(pack.compress(r) for r in records)


def iterate_archive(content: bytes):
    """The records of an archive, one frame at a time."""
    import zstandard

    magic, size = struct.unpack_from("<II", content)
    if magic != DICTIONARY_MAGIC:
        raise ValueError("an archive must start with its dictionary frame")
    data, at, step = memoryview(content), 8 + size, 1 << 15
    unpack = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(bytes(data[8: at])))
    while at < len(data):
        frame, out = unpack.decompressobj(), []
        while not frame.eof:
            if at >= len(data):
                raise ValueError("an archive ends inside a record")
            piece = data[at: at + step]
            out.append(frame.decompress(piece))
            at += len(piece) - len(frame.unused_data)
        yield b"".join(out)


def _revisits(pages: DataFrame, least: int) -> DataFrame:
    """``(page_id, sha, refers_to)`` of pages whose payload another page has."""
    known = pages.where(F.col("page_id").isNotNull() & (F.octet_length("payload") >= least)).select("page_id", "sha")
    last = known.groupBy("sha").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n")).where("n > 1")
    return known.join(last, "sha").where("page_id < refers_to").select("page_id", "sha", "refers_to").distinct()


def write_archives(df: DataFrame, date: str = "2024-01-01T00:00:00Z", least: int = 0, archive_bytes: int = ARCHIVE_BYTES,
                   id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """A record for every row, in archives: a written table (path, content).

    The payload is the html in UTF-8 (null: empty).  Of rows with equal
    payloads of at least ``least`` bytes that with the largest id is the
    response and others revisit it; if rows repeat that id, all of them are
    responses.  A row with a null id is always a response.  Further columns
    are ignored; an empty table gives no archive.  An archive is closed at
    ``archive_bytes`` before compression, so a task holds no more than that
    and one record.
    """
    pages = df.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                      F.coalesce(F.col(html_col).cast("string"), F.lit("")).cast("binary").alias("payload"))
    pages = pages.withColumn("sha", F.sha1("payload"))
    again = written(_revisits(pages, least), "revisits")
    records = pages.join(again, ["page_id", "sha"], "left").select("page_id", "url", "payload", "refers_to")

    def work(batches):
        import pyarrow as pa

        def archive(held):
            name = f"{hashlib.sha1(b''.join(hashlib.sha1(r).digest() for r in held)).hexdigest()}.warc.zst"
            return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([build_archive(held)], pa.binary())], ["path", "content"])

        held, size = [], 0
        for batch in batches:
            for i in range(batch.num_rows):
                page_id, url, payload, refers_to = (batch.column(c)[i].as_py() for c in range(4))
                held.append(build_record(page_id, url, payload, refers_to, date))
                size += len(held[-1])
                if size >= archive_bytes:
                    yield archive(held)
                    held, size = [], 0
        if held:
            yield archive(held)

    return written(records.mapInArrow(work, "path string, content binary"), "archives")


def read_archives(archives: DataFrame) -> DataFrame:
    """The records of archives (path, content): see RECORDS.  A revisit has
    no payload; its length and digest are those of the full one."""

    def work(batches):
        import pyarrow as pa

        names = [c.split()[0] for c in RECORDS.split(", ")]
        types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]

        def batch_of(rows):
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), types)], names)

        for batch in batches:
            for i in range(batch.num_rows):
                rows, size = [], 0
                for record in iterate_archive(batch.column(0)[i].as_py()):
                    rows.append(parse_record(record))
                    size += len(record)
                    if size >= ARCHIVE_BYTES:
                        yield batch_of(rows)
                        rows, size = [], 0
                if rows:
                    yield batch_of(rows)

    return archives.select("content").mapInArrow(work, RECORDS)


def export_archives(archives: DataFrame, folder: str) -> None:
    """Write every archive as a file of a folder that all executors mount."""

    def work(rows):
        import os

        os.makedirs(folder, exist_ok=True)
        for row in rows:
            with open(os.path.join(folder, row.path), "wb") as f:
                f.write(row.content)

    archives.foreachPartition(work)
