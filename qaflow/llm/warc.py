"""Web archives: a writer of one gzip member per record and a sequential, verifying reader.

Writer: every task writes its rows to archives of its own in the given folder (any file system that
``pyarrow.fs`` reaches by its address, the shared checkpoint folder by default). An archive's name holds
a random id of the task's attempt, and only archives listed in the written manifest count, so a lost
executor or a second attempt leaves no doubtful file behind. Equal payloads are written once: the row
with the largest ``page_id`` is the ``response``, the others are ``revisit`` records that refer to it.

Reader: one archive a task, read in blocks of 64 KiB through an incremental ``zlib`` decompressor, one
member after the other; the record is framed by its ``Content-Length`` and its block and payload digests
are computed while it streams past, so a record's payload is held only when it is asked for.

Defined cases: a null ``html`` is an empty payload; a null ``url`` gives a record without target; a null
``page_id`` counts as the smallest; repeated rows that tie for the largest ``page_id`` are all responses;
an empty table gives no archive and no rows; columns other than the three named ones are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qaflow.llm.common import materialise, read
from qaflow.session import scratch_path

ROLL_BYTES = 64 << 20
MIN_REVISIT_BYTES = 0
READ_BYTES = 64 << 10
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "path string, records long, bytes long"
RECORDS = ("page_id long, url string, record_type string, payload_digest string, payload_bytes long, "
           "refers_to long, digest_ok boolean, payload binary")


def _open(path: str):
    """File system and path of an address in Hadoop's or plain style."""
    path = re.sub(r"^file:/+", "/", path)
    path = re.sub(r"^s3[an]://", "s3://", path)
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)


def _sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_bytes(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One record, not compressed. A revisit keeps the HTTP head, with the payload's length, and no payload."""
    head = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode()
    block = head + payload if refers_to is None else head
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
             f"WARC-Record-ID: <urn:page:{'null' if page_id is None else page_id}>", "WARC-Date: 2000-01-01T00:00:00Z"]
    if url is not None:
        lines.append("WARC-Target-URI: " + quote(url, safe="%/:=&?~#+!$,;'@()*[]", errors="replace"))
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {REVISIT_PROFILE}"]
    lines += [f"WARC-Payload-Digest: sha1:{_sha1(payload)}", f"WARC-Block-Digest: sha1:{_sha1(block)}",
              "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def with_revisits(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """``page_id, url, html, refers_to``: the largest page_id of every repeated payload, for the others of it.

    Only digests that occur twice are joined back; a payload shared by a third of all rows is aggregated
    before the shuffle, and its join partition is split by AQE.
    """
    p = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    p = p.withColumn("sha", F.sha1("html"))
    twice = (p.where(F.octet_length("html") >= min_bytes).groupBy("sha")
             .agg(F.max("page_id").alias("keep"), F.count("*").alias("n")).where("n > 1").select("sha", "keep"))
    differs = F.col("page_id").isNull() | (F.col("page_id") < F.col("keep"))
    return p.join(twice, "sha", "left").select("page_id", "url", "html", F.when(differs, F.col("keep")).alias("refers_to"))


def write_archives(records: DataFrame, folder: str | None = None, roll_bytes: int = ROLL_BYTES) -> DataFrame:
    """Write ``page_id, url, html, refers_to`` rows; the manifest of the archives that count."""
    folder = folder or scratch_path(records.sparkSession, "warc")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _open(folder)
        fs.create_dir(base, recursive=True)
        out, done, n, size = None, [], 0, 0
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html", "refers_to"))):
                if out is None:
                    name = f"{uuid.uuid4().hex}.warc.gz"
                    out, n, size = fs.open_output_stream(f"{base}/{name}", compression=None), 0, 0
                data = gzip.compress(record_bytes(row[0], row[1], (row[2] or "").encode("utf-8", "surrogatepass"), row[3]), 6, mtime=0)
                out.write(data)
                n, size = n + 1, size + len(data)
                if size >= roll_bytes:
                    out.close()
                    done.append((f"{folder}/{name}", n, size))
                    out = None
        if out is not None:
            out.close()
            done.append((f"{folder}/{name}", n, size))
        yield pa.RecordBatch.from_arrays(
            [pa.array([d[0] for d in done], pa.string()), pa.array([d[1] for d in done], pa.int64()), pa.array([d[2] for d in done], pa.int64())],
            names=["path", "records", "bytes"])

    rows = records.select("page_id", "url", "html", "refers_to")
    return materialise(rows.mapInArrow(write, MANIFEST), "warc-manifest")


class _Record:
    """Takes a record's decompressed bytes as they come; frames them by its own Content-Length."""

    def __init__(self, keep_payload: bool):
        self.buf, self.head, self.left, self.keep = b"", None, 0, keep_payload
        self.block, self.payload, self.http, self.parts = hashlib.sha1(), hashlib.sha1(), None, []
        self.http_buf, self.payload_bytes, self.tail = b"", 0, b""

    def feed(self, data: bytes) -> None:
        if self.head is None:
            self.buf += data
            end = self.buf.find(b"\r\n\r\n")
            if end < 0:
                return
            lines = self.buf[:end].decode("utf-8").split("\r\n")
            if not lines[0].startswith("WARC/"):
                raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
            self.head = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
            self.left = int(self.head["content-length"])
            data, self.buf = self.buf[end + 4:], b""
        block, rest = data[:self.left], data[self.left:]
        self.left -= len(block)
        self.tail += rest
        if block:
            self.block.update(block)
            self._entity(block)

    def _entity(self, block: bytes) -> None:
        if self.http is None:
            self.http_buf += block
            end = self.http_buf.find(b"\r\n\r\n")
            if end < 0:
                return
            lines = self.http_buf[:end].decode("latin-1").split("\r\n")
            self.http = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
            block, self.http_buf = self.http_buf[end + 4:], b""
        self.payload.update(block)
        self.payload_bytes += len(block)
        if self.keep and block:
            self.parts.append(block)

    def row(self) -> dict:
        if self.head is None or self.left or self.tail != b"\r\n\r\n":
            raise ValueError("record does not end with its gzip member")
        b32 = lambda h: base64.b32encode(h.digest()).decode()
        urn = lambda k: None if (v := self.head.get(k, "<urn:page:null>")[10:-1]) == "null" else int(v)
        kind, said = self.head["warc-type"], self.head.get("warc-payload-digest", "").removeprefix("sha1:")
        ok = b32(self.block) == self.head.get("warc-block-digest", "").removeprefix("sha1:")
        if kind == "response":
            ok = ok and b32(self.payload) == said
        size = self.payload_bytes if kind == "response" else int((self.http or {}).get("content-length", 0))
        return {"page_id": urn("warc-record-id"), "url": self.head.get("warc-target-uri"), "record_type": kind, "payload_digest": said,
                "payload_bytes": size, "refers_to": urn("warc-refers-to"), "digest_ok": ok,
                "payload": b"".join(self.parts) if self.keep and kind == "response" else None}


def records_of(stream, keep_payload: bool = True, read_bytes: int = READ_BYTES) -> Iterator[dict]:
    """The records of one archive, in order, from anything with ``read(n)``."""
    member, record = None, None
    data = b""
    while True:
        data = data or stream.read(read_bytes)
        if not data:
            if member is not None:
                raise ValueError("archive ends inside a gzip member")
            return
        if member is None:
            member, record = zlib.decompressobj(wbits=31), _Record(keep_payload)
        piece = member.decompress(data, read_bytes * 4)
        while piece:
            record.feed(piece)
            piece = member.decompress(member.unconsumed_tail, read_bytes * 4) if member.unconsumed_tail else b""
        data = b""
        if member.eof:
            yield record.row()
            data, member = member.unused_data, None


def read_archives(manifest: DataFrame, keep_payload: bool = True) -> DataFrame:
    """Read the archives of ``manifest(path)``, one archive a task; ``digest_ok`` tells what failed."""
    names = [f.split()[0] for f in RECORDS.split(", ")]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.binary()]
        pack = lambda got: pa.RecordBatch.from_arrays([pa.array([g[n] for g in got], t) for n, t in zip(names, types)], names=names)
        for batch in batches:
            for path in batch.column("path").to_pylist():
                fs, p = _open(path)
                got, held = [], 0
                with fs.open_input_stream(p, compression=None) as stream:
                    for r in records_of(stream, keep_payload):
                        got.append(r)
                        held += len(r["payload"] or b"")
                        if len(got) >= 2000 or held >= 8 << 20:
                            yield pack(got)
                            got, held = [], 0
                yield pack(got)

    n = manifest.count()
    return manifest.select("path").repartition(max(1, n)).mapInArrow(rows, RECORDS)


def archive_round_trip(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES, keep_payload: bool = True) -> DataFrame:
    """Write every page, read the archives back."""
    return read_archives(write_archives(with_revisits(pages, min_bytes)), keep_payload)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_round_trip(read(spark, sf_dir, "pages"), keep_payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "digest_ok")


_B32 = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(h, {1 + 10 * k}, 10))::BIGINT >> {35 - 5 * j}) & 31)::INT, 1)"
    for k in range(4) for j in range(8))

SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
k AS (SELECT h, max(page_id) AS keep FROM p GROUP BY h)
SELECT page_id, octet_length(encode(html))::BIGINT AS payload_bytes, {_B32} AS payload_digest,
       CASE WHEN page_id = keep OR keep IS NULL THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = keep THEN NULL ELSE keep END AS refers_to, true AS digest_ok
FROM p JOIN k USING (h)
"""
