"""WARC archives: written by tasks, read back by tasks that split them.

Every record is a gzip member of its own, so an archive can be entered at any
member.  A reading task owns a range of bytes: it looks for the gzip magic, takes
a place for a member only if it decodes to a record header, its data are complete
(length and checksum) and another member or the end of the file follows, and then
goes from member to member.  A record belongs to the range in which its first
byte lies, however far it reaches.

Writing tasks name their files anew in every attempt and report them; only
reported files are read, so a repeated task leaves no double records.

Defined results: a null payload is an empty one; a null address is left out; a
null id is written as an empty one and never answers for others (its copies are
responses unless a copy with an id exists); of repeated ids with one payload all
rows of the smallest id are responses; an empty table gives no archives and an
empty result; other columns are not looked at.  A damaged archive raises an error.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorefold.llm.common import small, written
from scorefold.session import scratch_path

#: Payloads below this length are never revisits.
LEAST_REVISIT = 100
#: Bytes of an archive file, of a reading task's range, of a read, and of a record's data in a batch.
FILE_BYTES = 1 << 30
SPLIT_BYTES = 8 << 20
READ_BYTES = 1 << 18
BATCH_BYTES = 16 << 20
#: Repeated payloads' digests (about 80 bytes each) are broadcast up to this many, else joined by shuffle.
BROADCAST_ROWS = 200_000
MAGIC = b"\x1f\x8b\x08"
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def record(page_id: int | None, url: str | None, payload: bytes, length: int, digest: str, refers_to: int | None, date: str = DATE) -> bytes:
    """A response or, with refers_to, a revisit record; a revisit carries the HTTP header only."""
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()
    revisit = refers_to is not None
    block += b"" if revisit else payload
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{_id(page_id)}>", f"WARC-Date: {date}",
        *([f"WARC-Target-URI: {_address(url)}"] if url is not None else []), f"WARC-Payload-Digest: sha256:{digest}",
        *([f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {PROFILE}"] if revisit else []),
        "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", "",
    ]
    return "\r\n".join(head).encode() + block + b"\r\n\r\n"


def _id(page_id: int | None) -> str:
    return "" if page_id is None else str(page_id)


def _address(url: str) -> str:
    """Control characters and blanks would end the header line."""
    return "".join(f"%{ord(c):02X}" if ord(c) <= 32 or ord(c) == 127 else c for c in url)


def _member(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def _written(folder: str, file_bytes: int):
    def write(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, at = fs.FileSystem.from_uri(folder)
        part, files, out = TaskContext.get().partitionId(), [], None
        for batch in rows:
            for page_id, url, html, digest, first in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html", "digest", "first")), strict=True):
                if out is None:
                    name = f"part-{part:06d}-{uuid.uuid4().hex}.warc.gz"
                    out, size, n = store.open_output_stream(f"{at}/{name}", compression=None), 0, 0
                payload = (html or "").encode()
                data = _member(record(page_id, url, payload, len(payload), digest, first))
                out.write(data)
                size, n = size + len(data), n + 1
                if size >= file_bytes:
                    out.close()
                    files.append((f"{folder}/{name}", size, n))
                    out = None
        if out is not None:
            out.close()
            files.append((f"{folder}/{name}", size, n))
        if files:
            yield pa.record_batch([pa.array(c) for c in zip(*files, strict=True)], names=["path", "bytes", "records"])

    return write


def write_archives(pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", payload: str = "html",
                   least: int = LEAST_REVISIT, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write one record per row below folder; path, bytes, records of the archives.

    Of equal payloads of at least `least` bytes, that of the smallest id is a response
    and the others revisit it.
    """
    store, at = fs.FileSystem.from_uri(folder)
    store.create_dir(at, recursive=True)
    body = F.encode(F.coalesce(F.col(payload), F.lit("")), "UTF-8")
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"), F.col(payload).alias("html"), F.sha2(body, 256).alias("digest"), F.length(body).alias("size"))
    groups = rows.where(F.col("size") >= least).groupBy("digest").agg(F.count("*").alias("n"), F.min("page_id").alias("least"))
    groups = written(groups.where("n > 1").select("digest", "least"), "warc-copies")
    marked = rows.join(small(groups, groups.count(), BROADCAST_ROWS), "digest", "left")
    first = F.when(~F.col("page_id").eqNullSafe(F.col("least")), F.col("least"))
    ready = marked.select("page_id", "url", "html", "digest", first.alias("first"))
    return written(ready.mapInArrow(_written(folder, file_bytes), "path string, bytes long, records long"), "warc-files")


class Record(NamedTuple):
    offset: int
    end: int
    data: bytes


class _Reader:
    """Members of one archive file, found and decoded."""

    def __init__(self, file: pa.NativeFile):
        self.file, self.size = file, file.size()

    def _bytes(self, at: int, n: int) -> bytes:
        self.file.seek(at)
        return self.file.read(min(n, self.size - at))

    def decoded(self, at: int, most: int | None = None) -> tuple[bytes, int] | None:
        """Data of the member at this place and where it ends (only its first bytes, with most), or None if there is none."""
        unpacker, out, place = zlib.decompressobj(31), bytearray(), at
        try:
            while not unpacker.eof:
                if place >= self.size:
                    return None
                chunk = self._bytes(place, READ_BYTES if most is None else 4096)
                place += len(chunk)
                out += unpacker.decompress(chunk, 0 if most is None else most)
                if most is not None and (len(out) >= 5 or place - at > 65_536):
                    break
        except zlib.error:
            return None
        if out[:5] != b"WARC/":
            return None
        return bytes(out), place - len(unpacker.unused_data)

    def starts(self, at: int) -> bool:
        """Whether a record's member, or the end of the file, is at this place."""
        return at == self.size or (self._bytes(at, 3) == MAGIC and self.decoded(at, 64) is not None)

    def first(self, start: int, end: int) -> Record | None:
        """The first record that starts in the range."""
        place = start
        while place < end:
            chunk = self._bytes(place, READ_BYTES + 2)
            hit = chunk.find(MAGIC)
            while hit >= 0 and place + hit < end and hit < READ_BYTES:
                found = self.decoded(place + hit, 64) and self.decoded(place + hit)
                if found and self.starts(found[1]):
                    return Record(place + hit, found[1], found[0])
                hit = chunk.find(MAGIC, hit + 1)
            place += READ_BYTES
        return None

    def records(self, start: int, end: int) -> Iterator[Record]:
        """All records that start in the range."""
        found = self.first(start, min(end, self.size))
        if found is None or (start == 0 and found.offset):
            if start == 0 and self.size:
                raise ValueError("no record at the start of the archive")
            return
        while True:
            yield found
            if found.end >= min(end, self.size):
                return
            member = self.decoded(found.end)
            if member is None:
                raise ValueError(f"no record at byte {found.end}")
            found = Record(found.end, member[1], member[0])


def parsed(data: bytes) -> dict:
    """The fields of a record: header fields by lower-case name, HTTP length, payload."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
    n = int(fields["content-length"])
    if not version.startswith("WARC/") or len(rest) < n + 4 or rest[n : n + 4] != b"\r\n\r\n":
        raise ValueError("a record's length is wrong")
    http, _, payload = rest[:n].partition(b"\r\n\r\n")
    length = next((int(x.partition(b":")[2]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")), None)
    return fields | {"http-length": length, "payload": payload}


_RECORDS = "path string, offset long, type string, record_id string, refers_to string, uri string, digest string, http_length long, payload binary"


def _read(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [x.split()[0] for x in _RECORDS.split(", ")]
    kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    types = [kinds[x.split()[1]] for x in _RECORDS.split(", ")]
    for batch in rows:
        for path, start, end in zip(*(batch.column(c).to_pylist() for c in ("path", "start", "end")), strict=True):
            store, at = fs.FileSystem.from_uri(path)
            out, size = [], 0
            with store.open_input_file(at) as file:
                for found in _Reader(file).records(start, end):
                    x = parsed(found.data)
                    out.append((path, found.offset, x.get("warc-type"), x.get("warc-record-id"), x.get("warc-refers-to"), x.get("warc-target-uri"),
                                x.get("warc-payload-digest"), x["http-length"], x["payload"]))
                    size += len(found.data)
                    if size >= BATCH_BYTES:
                        yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)
                        out, size = [], 0
            if out:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)


def read_archives(archives: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """path, bytes of archives -> one row per record: path, offset, type, record_id, refers_to, uri, digest, http_length, payload."""
    ranges = archives.where("bytes > 0").select("path", "bytes", F.explode(F.expr(f"sequence(0L, bytes - 1, {split_bytes}L)")).alias("start"))
    ranges = ranges.select("path", "start", F.least("bytes", F.col("start") + split_bytes).alias("end"))
    n = archives.agg(F.sum(F.expr(f"(bytes + {split_bytes - 1}) div {split_bytes}"))).first()[0] or 1
    return ranges.repartition(int(min(n, 100_000)), "path", "start").mapInArrow(_read, _RECORDS)


def archived(spark: SparkSession, pages: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Write pages to archives in the shared folder and read them back: page_id, payload_bytes, payload_digest, record_type, refers_to, url, payload."""
    files = write_archives(pages, scratch_path(spark, "warc"))
    records = read_archives(files, split_bytes)
    number = lambda c: F.regexp_extract(c, r"<urn:page:(-?\d+)>", 1).try_cast("long")
    response = F.col("type") == "response"
    return records.select(
        number(F.col("record_id")).alias("page_id"),
        F.when(response, F.length("payload")).otherwise(F.col("http_length")).cast("long").alias("payload_bytes"),
        F.when(response, F.sha2("payload", 256)).otherwise(F.regexp_replace("digest", "^sha256:", "")).alias("payload_digest"),
        F.col("type").alias("record_type"), number(F.col("refers_to")).alias("refers_to"), F.col("uri").alias("url"), "payload",
    )
