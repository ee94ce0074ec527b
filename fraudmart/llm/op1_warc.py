"""WARC archives: writer, and a sequential reader.

Writer: one gzip member per record. Payloads of ``min_bytes`` or more that occur
more than once are stored once, as the ``response`` of the largest id; the
others become ``revisit`` records whose HTTP header keeps the full length.
Archives go to the shared folder under fresh names; only those in the returned
manifest count, so a retried task leaves nothing that is read.

Reader: one task per archive, decompressing 64 KiB at a time; records are framed
by their content length and the block and payload digests are verified as the
bytes pass, so a task holds one decompressed piece (and the payload, if asked
for).

Cases: a null payload is an empty one; a null id is written as ``none`` and never
wins over another id; of repeated rows with the largest id each is a response;
a null or odd URL is left out or percent-encoded; an empty table gives an empty
manifest; other columns are ignored. A truncated or corrupt member is returned
with ``status`` saying so and ends its archive; wrong digests or lengths give
``status`` ``bad_digest`` or ``bad_length`` and reading goes on.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudmart.llm.common import filesystem, join_path, prepare, stored
from fraudmart.session import scratch_path

PIECE = 1 << 16
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = ("archive string, offset long, status string, record_id string, record_type string, "
          "target_uri string, refers_to string, payload_bytes long, payload_digest string")


def _sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def _urn(key: int | None) -> str:
    return f"<urn:page:{'none' if key is None else key}>"


def record_bytes(key: int | None, url: str | None, payload: bytes, refers_to: int | None,
                 date: str) -> bytes:
    """One WARC record (uncompressed); ``refers_to`` makes it a revisit."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    block = http + (payload if refers_to is None else b"")
    head = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", _urn(key)),
            ("WARC-Date", date)]
    if url:
        head.append(("WARC-Target-URI", quote(url, safe="%/:=&?~#+!$,;'@()*[]")))
    if refers_to is not None:
        head += [("WARC-Profile", PROFILE), ("WARC-Refers-To", _urn(refers_to))]
    head += [("WARC-Payload-Digest", _sha1(payload)), ("WARC-Block-Digest", _sha1(block)),
             ("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    lines = "".join(f"{k}: {v}\r\n" for k, v in head)
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url: str = "url",
                   payload: str = "html", min_bytes: int = 1000, max_archive_bytes: int = 1 << 28,
                   date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Write every row as a record; returns the manifest (archive, records, bytes)."""
    prepare(pages.sparkSession)
    rows = pages.select(F.col(f"`{id_col}`").cast("long").alias("key"), F.col(f"`{url}`").cast("string").alias("url"),
                        F.coalesce(F.col(f"`{payload}`").cast("binary"), F.lit(b"")).alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    # stored, so that its size is known when the join is planned
    firsts = stored(rows.filter(F.octet_length("payload") >= min_bytes).groupBy("digest")
                    .agg(F.max("key").alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n"),
                    "warc-firsts")
    rows = rows.join(firsts, "digest", "left").select(
        "key", "url", "payload",
        F.when(F.col("key").isNull() | (F.col("key") != F.col("first")), F.col("first")).alias("refers_to"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = filesystem(folder)
        fs.create_dir(base, recursive=True)
        out, name, done, size, n = None, "", [], 0, 0
        for batch in batches:
            for r in batch.to_pylist():
                if out is None:
                    name, size, n = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = fs.open_output_stream(join_path(base, name))
                data = member(record_bytes(r["key"], r["url"], r["payload"], r["refers_to"], date))
                out.write(data)
                size, n = size + len(data), n + 1
                if size >= max_archive_bytes:
                    out.close()
                    out = None
                    done.append((join_path(folder, name), n, size))
        if out is not None:
            out.close()
            done.append((join_path(folder, name), n, size))
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], ["archive", "records", "bytes"])

    return stored(rows.mapInArrow(write, "archive string, records long, bytes long"), "warc-manifest")


class _Record:
    """Frames and checks one record as its decompressed pieces arrive."""

    def __init__(self, keep: bool):
        self.head, self.fields, self.left, self.keep = b"", None, 0, keep
        self.http, self.seen, self.tail = b"", 0, b""
        self.block_sha, self.payload_sha, self.payload, self.length = hashlib.sha1(), hashlib.sha1(), [], 0
        self.in_payload = False

    def feed(self, data: bytes) -> None:
        if self.fields is None:
            self.head += data
            at = self.head.find(b"\r\n\r\n")
            if at < 0:
                return
            lines = self.head[:at].decode("utf-8", "replace").split("\r\n")[1:]
            self.fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
            self.left = int(self.fields.get("content-length", "0"))
            data, self.head = self.head[at + 4:], b""
        block, self.tail = data[:self.left], (self.tail + data[self.left:])[:64]
        self.left -= len(block)
        self.block_sha.update(block)
        if not self.in_payload:
            self.http += block
            at = self.http.find(b"\r\n\r\n")
            if at < 0:
                return
            block, self.http, self.in_payload = self.http[at + 4:], self.http[:at], True
        self.payload_sha.update(block)
        self.length += len(block)
        if self.keep:
            self.payload.append(block)

    def row(self, archive: str, offset: int) -> dict:
        f = self.fields or {}
        kind = f.get("warc-type")
        full = self.length
        for line in self.http.decode("latin-1").split("\r\n"):
            if kind == "revisit" and line.lower().startswith("content-length:"):
                full = int(line.partition(":")[2])
        b32 = lambda sha: "sha1:" + base64.b32encode(sha.digest()).decode()
        said = f.get("warc-payload-digest", "")
        status = "ok"
        if self.fields is None or self.left or self.tail != b"\r\n\r\n":
            status = "bad_length"
        elif f.get("warc-block-digest", b32(self.block_sha)) != b32(self.block_sha) or (
                kind == "response" and said != b32(self.payload_sha)):
            status = "bad_digest"
        digest = base64.b32decode(said[5:]).hex() if said.startswith("sha1:") else None
        row = {"archive": archive, "offset": offset, "status": status, "record_id": f.get("warc-record-id"),
               "record_type": kind, "target_uri": f.get("warc-target-uri"), "refers_to": f.get("warc-refers-to"),
               "payload_bytes": full, "payload_digest": digest if kind == "revisit" else self.payload_sha.hexdigest()}
        if self.keep:
            row["payload"] = b"".join(self.payload)
        return row


def records(stream, archive: str, keep: bool = False) -> Iterator[dict]:
    """The records of one open archive, in order, a piece at a time."""
    z, record, offset, at = None, None, 0, 0
    data = stream.read(PIECE)
    while data:
        if z is None:
            z, record, offset = zlib.decompressobj(31), _Record(keep), at
        try:
            record.feed(z.decompress(data, PIECE))
            while z.unconsumed_tail and not z.eof:
                record.feed(z.decompress(z.unconsumed_tail, PIECE))
        except (zlib.error, ValueError):
            yield record.row(archive, offset) | {"status": "corrupt"}
            return
        rest = z.unused_data
        at += len(data) - len(rest)
        if z.eof:
            yield record.row(archive, offset)
            z = None
        data = rest or stream.read(PIECE)
    if z is not None:
        yield record.row(archive, offset) | {"status": "truncated"}


def read_archives(manifest: DataFrame, with_payload: bool = False) -> DataFrame:
    """Every record of the archives named in ``manifest.archive`` (see RECORD)."""
    prepare(manifest.sparkSession)
    schema = RECORD + (", payload binary" if with_payload else "")
    names = [x.split()[0] for x in schema.split(", ")]
    types = {"offset": pa.int64(), "payload_bytes": pa.int64(), "payload": pa.binary()}

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = lambda rows: pa.RecordBatch.from_arrays(
            [pa.array([r[n] for r in rows], types.get(n, pa.string())) for n in names], names)
        for batch in batches:
            for archive in batch.column(0).to_pylist():
                fs, path = filesystem(archive)
                with fs.open_input_stream(path) as stream:
                    held, size = [], 0
                    for row in records(stream, archive, with_payload):
                        held.append(row)
                        size += len(row.get("payload", b""))
                        if len(held) >= 1024 or size >= 1 << 25:
                            yield pack(held)
                            held, size = [], 0
                    if held:
                        yield pack(held)

    return manifest.select("archive").repartition(max(1, manifest.count())).mapInArrow(read, schema)


def round_trip(pages: DataFrame, min_bytes: int = 1000) -> DataFrame:
    """Write the pages to archives in the shared folder and read them back."""
    folder = scratch_path(pages.sparkSession, "warc")
    return read_archives(write_archives(pages, folder, min_bytes=min_bytes))
