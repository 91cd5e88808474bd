"""WARC archives: one gzip member per record, written by tasks and read back record by record.

Writing: pages with equal payloads are found by digest; the one with the smallest id becomes a ``response`` record, the others
``revisit`` records that refer to it and carry its HTTP headers without the payload. Each task streams its rows into
archives of about ``ARCHIVE_BYTES`` in a shared folder. A file's name is unique to the attempt and only the names that
successful tasks report count, so a lost or repeated task leaves no record twice.

Reading: a task opens an archive as a stream, inflates it piece by piece, takes header lines up to the blank line, then
``Content-Length`` bytes and the closing line breaks, and checks the block digest and, for responses, the payload digest.
Damaged records raise; nothing is skipped. Memory is one piece and one record.

Null html is an empty payload. A null id is written without a page id and read as null; null urls are left out. Repeated rows
become records of their own: of those with the smallest id and equal payload all are responses. An empty table gives no
archives and no records.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterable, Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadtally.llm.common import slices, written
from roadtally.session import scratch_path

ARCHIVE_BYTES = 64 << 20
READ_BYTES = 1 << 16
LEVEL = 6
# Payloads of at least so many bytes are looked up for revisits.
LEAST_REVISIT = 0
# The record version and the profile of a revisit with an identical payload.
VERSION = b"WARC/1.1"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_ID = "urn:page:"
WHEN = "2000-01-01T00:00:00Z"

RECORDS = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"


def base32_of_hex(digest: Column) -> Column:
    """A 40-digit hex SHA-1 as upper-case base32: five hex digits make four base32 digits."""
    part = lambda i: F.lpad(F.conv(F.substring(digest, 5 * i + 1, 5), 16, 32), 4, "0")
    return F.translate(
        F.concat(*[part(i) for i in range(8)]), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    )


def with_references(pages: DataFrame) -> DataFrame:
    """Pages with payload size and digest; rows that revisit another page have its id and no payload."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        payload.alias("payload"),
        F.octet_length(payload).cast("long").alias("payload_bytes"),
        base32_of_hex(F.sha1(payload)).alias("payload_digest"),
    )
    # Written, so that both sides of the join are plain exchanges and a hot payload's rows can be split.
    first = written(
        rows.where(F.col("payload_bytes") >= LEAST_REVISIT)
        .groupBy("payload_digest")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("copies"))
        .where("copies > 1")
        .select("payload_digest", "first"),
        "first",
    )
    revisits = F.col("first") != F.col("page_id")
    return rows.join(first, "payload_digest", "left").select(
        "page_id",
        "url",
        F.when(~F.coalesce(revisits, F.lit(False)), F.col("payload")).alias("payload"),
        "payload_bytes",
        "payload_digest",
        F.when(revisits, F.col("first")).alias("refers_to"),
    )


def _sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(page_id, url, payload, payload_bytes, payload_digest, refers_to) -> bytes:
    """One record as a gzip member of its own."""
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {payload_bytes}\r\n\r\n".encode()
    block += payload or b""
    headers = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"),
        ("WARC-Date", WHEN),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Block-Digest", _sha1(block)),
        ("WARC-Payload-Digest", f"sha1:{payload_digest}"),
    ]
    if page_id is not None:
        headers.append(("WARC-Page-ID", f"<{RECORD_ID}{page_id}>"))
    if url is not None:
        headers.append(("WARC-Target-URI", quote(url, safe=":/?#[]@!$&'()*+,;=~")))
    if refers_to is not None:
        headers += [("WARC-Profile", SAME_PAYLOAD), ("WARC-Refers-To", f"<{RECORD_ID}{refers_to}>")]
    headers.append(("Content-Length", str(len(block))))
    head = VERSION + b"\r\n" + b"".join(f"{k}: {v}\r\n".encode() for k, v in headers) + b"\r\n"
    member = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return member.compress(head + block + b"\r\n\r\n") + member.flush()


def write_archives(rows: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write the rows of ``with_references`` below a shared folder; ``(path, n_records)`` per archive, already computed."""

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        files, top = fs.FileSystem.from_uri(folder)
        files.create_dir(top, recursive=True)
        out, count, name, size = None, 0, "", 0

        def closed():
            out.close()
            return pa.RecordBatch.from_pydict({"path": [f"{folder}/{name}"], "n_records": [count]})

        for batch in slices(batches, "payload"):
            for row in batch.to_pylist():
                if out is None:
                    name, count, size = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = files.open_output_stream(f"{top}/{name}", compression=None)
                member = record(**row)
                out.write(member)
                count, size = count + 1, size + len(member)
                if size >= archive_bytes:
                    yield closed()
                    out = None
        if out is not None:
            yield closed()

    return written(rows.mapInArrow(write, "path string, n_records long"), "archives")


class Members:
    """A file of gzip members as one stream of bytes, inflated piece by piece."""

    def __init__(self, stream):
        self.stream, self.inflate, self.left, self.ready = stream, None, b"", bytearray()
        self.begun = 0  # members

    def more(self) -> bool:
        """Inflate one more piece; False at the end of the file."""
        data = self.left or self.stream.read(READ_BYTES)
        if not data:
            if self.inflate is not None:
                raise ValueError("the archive ends inside a member")
            return False
        if self.inflate is None:
            self.inflate = zlib.decompressobj(31)
            self.begun += 1
        self.ready += self.inflate.decompress(data, READ_BYTES)
        self.left = self.inflate.unconsumed_tail
        if self.inflate.eof:
            self.left, self.inflate = self.inflate.unused_data, None
        return True

    def until(self, mark: bytes) -> bytes | None:
        """Bytes up to and with a mark; None if the file ended before a further byte."""
        seen = 0
        while (at := self.ready.find(mark, seen)) < 0:
            seen = max(0, len(self.ready) - len(mark) + 1)
            if not self.more():
                if self.ready:
                    raise ValueError("the archive ends inside a record")
                return None
        return self.exactly(at + len(mark))

    def at_end(self) -> bool:
        """Whether the bytes read so far end with a member."""
        while self.inflate is not None and not self.ready:
            self.more()
        return not self.ready and self.inflate is None

    def exactly(self, size: int) -> bytes:
        while len(self.ready) < size:
            if not self.more():
                raise ValueError("the archive ends inside a record")
        out = bytes(self.ready[:size])
        del self.ready[:size]
        return out


def records(stream) -> Iterator[dict]:
    """All records of an archive in order, as rows of ``RECORDS``; raises on a damaged one."""
    members = Members(stream)
    n = 0
    while (head := members.until(b"\r\n\r\n")) is not None:
        n += 1
        lines = head[:-4].decode().split("\r\n")
        if lines[0].encode() != VERSION:
            raise ValueError(f"not a record: {lines[0][:40]!r}")
        headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        block = members.exactly(int(headers["content-length"]))
        if members.exactly(4) != b"\r\n\r\n":
            raise ValueError("a record is longer than its Content-Length")
        if not members.at_end() or members.begun != n:
            raise ValueError("a record is not a member of its own")
        if _sha1(block) != headers["warc-block-digest"]:
            raise ValueError("a block does not match its digest")
        http, _, payload = block.partition(b"\r\n\r\n")
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(b":") for x in http.split(b"\r\n")[1:])}
        kind, digest = headers["warc-type"], headers["warc-payload-digest"]
        if kind == "response" and (_sha1(payload) != digest or len(payload) != int(fields[b"content-length"])):
            raise ValueError("a payload does not match its digest")
        number = lambda key: int(headers[key].strip("<>").removeprefix(RECORD_ID)) if key in headers else None
        yield {
            "page_id": number("warc-page-id"),
            "url": unquote(headers["warc-target-uri"]) if "warc-target-uri" in headers else None,
            "record_type": kind,
            "refers_to": number("warc-refers-to"),
            "payload_bytes": int(fields[b"content-length"]),
            "payload_digest": digest.removeprefix("sha1:"),
            "payload": payload if kind == "response" else None,
        }


def read_archives(archives: DataFrame, columns: Iterable[str] | None = None, rows: int = 256) -> DataFrame:
    """Records of the archives named in ``archives(path)``, a task for each of them; ``columns`` narrows them."""
    kinds = dict(x.split() for x in RECORDS.split(", "))
    wanted = list(columns or kinds)
    schema = pa.schema([(c, {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}[kinds[c]]) for c in wanted])

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        for batch in batches:
            for path in batch.column("path").to_pylist():
                files, name = fs.FileSystem.from_uri(path)
                with files.open_input_stream(name, compression=None) as stream:
                    held = []
                    for found in records(stream):
                        held.append({c: found[c] for c in wanted})
                        if len(held) >= rows:
                            yield pa.RecordBatch.from_pylist(held, schema)
                            held = []
                    yield pa.RecordBatch.from_pylist(held, schema)

    # A number given here is kept: adaptive execution would merge the few small rows into one task.
    paths = archives.select("path").repartitionByRange(max(1, archives.count()), "path")
    return paths.mapInArrow(read, ", ".join(f"{c} {kinds[c]}" for c in wanted))


def archive_folder(spark: SparkSession) -> str:
    """A new shared folder for archives, as a URI."""
    path = scratch_path(spark, "warc")
    return path if "://" in path or path.startswith("file:") else f"file://{path}"
