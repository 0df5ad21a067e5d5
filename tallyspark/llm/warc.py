"""WARC archives: a writer that stores equal payloads once, and a sequential reader.

Archives are gzip files with one member per record, written by Spark tasks to a shared folder. A task names its files by
its partition and renames them when they are complete, so a repeated task replaces what a lost one left behind.

Defined cases: a null payload is an empty one. A null id takes part like any other, but never is the one referred to; if
all ids of a group are null, each record is a response. Rows that repeat an id and its payload each get a record of the
same type. Empty tables give no archives and no records. Columns other than the named three are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.common import bounded_batches, checked_join, fresh_dir, need, table, written

MANIFEST = "path string, records long, bytes long"
RECORDS = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, digest_ok boolean, payload binary"
#: Record ids are UUIDs: this prefix, a sign of null, and the row's id.
ID_PREFIX = 0x7A11_59A2_0000_8000
DATE = b"2024-01-01T00:00:00Z"
PROFILE = b"http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _record_id(page_id: int | None) -> bytes:
    if page_id is None:
        return b"<urn:uuid:" + str(uuid.uuid5(uuid.NAMESPACE_OID, "no id")).encode() + b">"
    return b"<urn:uuid:" + str(uuid.UUID(int=(ID_PREFIX << 64) | (page_id & (2**64 - 1)))).encode() + b">"


def _id_of(record_id: bytes) -> int | None:
    value = uuid.UUID(record_id.strip(b"<>").rpartition(b":")[2].decode()).int
    if value >> 64 != ID_PREFIX:
        return None
    low = value & (2**64 - 1)
    return low - 2**64 if low >= 2**63 else low


def _base32(digest: bytes) -> bytes:
    return base64.b32encode(digest)


def _member(page_id, url, payload: bytes, refers_to, level: int) -> bytes:
    """One record as a gzip member of its own."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    uri = (url or "").replace("\r", "%0D").replace("\n", "%0A").encode()
    head = [
        b"WARC/1.1",
        b"WARC-Type: " + (b"revisit" if refers_to is not None else b"response"),
        b"WARC-Record-ID: " + _record_id(page_id),
        b"WARC-Date: " + DATE,
        *([b"WARC-Target-URI: " + uri] if url is not None else []),
        b"WARC-Payload-Digest: sha1:" + _base32(hashlib.sha1(payload).digest()),
        b"WARC-Block-Digest: sha1:" + _base32(hashlib.sha1(block).digest()),
        *([b"WARC-Refers-To: " + _record_id(refers_to), b"WARC-Profile: " + PROFILE] if refers_to is not None else []),
        b"Content-Type: application/http; msgtype=response",
        b"Content-Length: %d" % len(block),
    ]
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return b"".join((packer.compress(b"\r\n".join(head) + b"\r\n\r\n"), packer.compress(block), packer.compress(b"\r\n\r\n"), packer.flush()))


def _writer(directory: str, max_bytes: int, level: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pyarrow.fs.FileSystem.from_uri(directory)
        task = TaskContext.get()
        part, attempt = task.partitionId(), task.taskAttemptId()
        out, n, size, done, made = None, 0, 0, 0, []

        def close():
            out.close()
            name = f"{root}/part-{part:05d}-{done:05d}.warc.gz"
            fs.move(f"{root}/_{attempt}-{done}.tmp", name)
            made.append((name, n, size))

        for batch in batches:
            for page_id, url, payload, refers_to in zip(*(batch.column(i) for i in range(4)), strict=True):
                if out is None:
                    out, n, size = fs.open_output_stream(f"{root}/_{attempt}-{done}.tmp"), 0, 0
                member = _member(page_id.as_py(), url.as_py(), (payload.as_py() or "").encode(), refers_to.as_py(), level)
                out.write(member)
                n, size = n + 1, size + len(member)
                if size >= max_bytes:
                    close()
                    out, done = None, done + 1
        if out is not None:
            close()
        if made:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*made, strict=True), (pa.string(), pa.int64(), pa.int64()), strict=True)], ["path", "records", "bytes"])

    return write


def write_warc(pages: DataFrame, directory: str, id_col="page_id", url_col="url", payload_col="html", min_revisit_bytes: int = 0, max_bytes: int = 64 << 20, level: int = 4) -> DataFrame:
    """Writes a record per row and returns the written manifest (path, records, bytes) of the archives. Ids are whole numbers.

    Among rows with equal payloads of at least min_revisit_bytes, those with the largest id become responses and the
    others revisits of it. Digests are grouped with partial sums, and only digests that occur twice are joined back: up to
    200,000 of them by broadcast, more by a shuffle of the rows, payloads included, as only their digest tells responses.
    """
    need(pages, id_col, url_col, payload_col)
    spark = pages.sparkSession
    bounded_batches(spark)
    fs, root = pyarrow.fs.FileSystem.from_uri(directory)
    fs.create_dir(root, recursive=True)
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("url"), F.coalesce(F.col(payload_col), F.lit("")).alias("payload"))
    rows = rows.withColumn("digest", F.unhex(F.sha1("payload")))
    large = rows.filter(F.octet_length("payload") >= min_revisit_bytes)
    twice = written(large.groupBy("digest").agg(F.max("id").alias("first"), F.count("*").alias("n")).filter("n > 1 and first is not null").select("digest", "first"), "warc-twice")
    rows = checked_join(rows, twice, ["digest"], "left", spread="id")
    rows = rows.select("id", "url", "payload", F.when(~F.col("first").eqNullSafe(F.col("id")), F.col("first")).alias("refers_to"))
    return written(rows.mapInArrow(_writer(directory, max_bytes, level), MANIFEST), "warc-manifest")


class _Stream:
    """Bytes of consecutive gzip members, decompressed bit by bit; a member's end is seen by read()."""

    def __init__(self, raw, chunk: int = 1 << 16):
        self.raw, self.chunk, self.rest, self.buffer, self.member = raw, chunk, b"", b"", None

    def next_member(self) -> bool:
        """Skips to the next member; False at the end of the file."""
        self.rest = self.rest or self.raw.read(self.chunk)
        self.member, self.buffer = zlib.decompressobj(31), b""
        return bool(self.rest)

    def fill(self) -> bool:
        if self.member.eof:
            return False
        given = self.member.unconsumed_tail or self.rest or self.raw.read(self.chunk)
        if not given:
            raise ValueError("the archive ends within a member")
        self.buffer += self.member.decompress(given, self.chunk * 4)
        self.rest = self.member.unused_data if self.member.eof else b""
        return True

    def head(self) -> bytes:
        """Up to the first empty line."""
        while (at := self.buffer.find(b"\r\n\r\n")) < 0:
            if not self.fill():
                raise ValueError("a record without the end of its header")
        out, self.buffer = self.buffer[:at], self.buffer[at + 4 :]
        return out

    def take(self, n: int) -> Iterator[bytes]:
        while n:
            if not self.buffer and not self.fill():
                raise ValueError("a record is shorter than its Content-Length")
            part, self.buffer = self.buffer[:n], self.buffer[n:]
            n -= len(part)
            yield part

    def finish(self) -> None:
        while self.fill():
            pass
        if self.buffer != b"\r\n\r\n":
            raise ValueError("a record is longer than its Content-Length")


def _fields(head: bytes) -> dict[bytes, bytes]:
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(b":") for x in head.split(b"\r\n")[1:])}


def read_records(raw, keep_payload: bool) -> Iterator[tuple]:
    """The records of one archive, in order; `raw` needs only read(n)."""
    stream = _Stream(raw)
    while stream.next_member():
        head = _fields(stream.head())
        left = int(head[b"content-length"])
        block, payload, kept, size, http = hashlib.sha1(), hashlib.sha1(), [], 0, b""
        parts, inside = stream.take(left), False
        for part in parts:
            block.update(part)
            if not inside:
                http += part
                if (at := http.find(b"\r\n\r\n")) < 0:
                    continue
                part, http, inside = http[at + 4 :], http[:at], True
            payload.update(part)
            size += len(part)
            if keep_payload:
                kept.append(part)
        stream.finish()
        kind, said = head[b"warc-type"], head[b"warc-payload-digest"].removeprefix(b"sha1:")
        ok = _base32(block.digest()) == head[b"warc-block-digest"].removeprefix(b"sha1:")
        full = int(_fields(http)[b"content-length"])
        if kind == b"response":
            ok = ok and _base32(payload.digest()) == said and size == full
        uri = head.get(b"warc-target-uri")
        refers = head.get(b"warc-refers-to")
        yield _id_of(head[b"warc-record-id"]), uri and uri.decode(), kind.decode(), full, said.decode(), refers and _id_of(refers), ok, b"".join(kept) if keep_payload and kind == b"response" else None


def read_warc(archives: DataFrame, directory: str, keep_payload: bool = True, batch_rows: int = 2_000, batch_bytes: int = 8 << 20) -> DataFrame:
    """A row per record of the archives in the column `path`: its fields, full payload length and digest, and whether
    digests and lengths hold. One archive is read by one task, as a stream; give archives of moderate size."""
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("digest_ok", pa.bool_()), ("payload", pa.binary())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = pyarrow.fs.FileSystem.from_uri(directory)
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows, size = [], 0
                with fs.open_input_stream(path, compression=None) as raw:
                    for record in read_records(raw, keep_payload):
                        rows.append(record)
                        size += len(record[-1] or b"")
                        if len(rows) >= batch_rows or size >= batch_bytes:
                            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
                            rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    n = max(1, archives.count())
    return archives.select("path").repartition(n).mapInArrow(read, RECORDS)


def op1_warc(spark, sf_dir):
    """Every page as a WARC record, written and read back."""
    at = fresh_dir(spark, "warc")
    archives = write_warc(table(spark, sf_dir, "pages"), at)
    return read_warc(archives, at, keep_payload=False).drop("payload")


#: Base32 of a SHA-1: eight groups of five hexadecimal digits, each four characters.
OP1_SQL = """
WITH p AS (SELECT page_id, url, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, url, octet_length(encode(html))::BIGINT AS payload_bytes, sha1(html) AS h FROM p),
b AS (SELECT page_id, url, payload_bytes, h,
  list_reduce(list_transform(range(0, 32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (((('0x' || substr(h, 1 + 5 * (i // 4)::INT, 5))::BIGINT) >> (15 - 5 * (i % 4))::INT) & 31)::INT, 1)), lambda x, y: x || y) AS payload_digest FROM d),
m AS (SELECT h, max(page_id) AS first FROM d GROUP BY h)
SELECT page_id, url, payload_bytes, payload_digest, true AS digest_ok,
  CASE WHEN page_id IS NOT DISTINCT FROM first OR first IS NULL THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM b JOIN m USING (h)
"""

QUERIES = {"op1_warc": op1_warc}
ORACLES = {"op1_warc": OP1_SQL}
