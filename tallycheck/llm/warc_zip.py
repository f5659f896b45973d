"""Web archives inside ZIP packages.

Writing: every task packs its records into ZIP archives with two stored members,
``archive/data.warc.gz`` (one gzip member a record) and ``indexes/index.cdxj``
(offset and length of each record), streamed into the cluster's shared folder.
Reading: the central directory, with its ZIP64 forms, gives the place of the
stored members; the index gives the place of each record; records are read by
byte range and nothing is extracted.

Of records with equal payloads (SHA-1 and length) of ``min_bytes`` or more, that
with the largest page id is the response; the others are revisits that refer to
it and store no payload.

Defined results: a null payload counts as empty; a null page id is smaller than
any other, and payloads with no other id are all responses, as are rows that
repeat the largest id; an empty table gives an empty result; other columns are
ignored. A lost task leaves at most an archive that no manifest row names.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import struct
import uuid
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallycheck.llm.common import same, shared_dir, written

DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
DATE = "2020-01-01T00:00:00Z"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# --- records ----------------------------------------------------------------

def record(page: object, url: str | None, payload: bytes, refers_to: object | None) -> bytes:
    """A WARC record: a response, or a revisit without its payload."""
    revisit = refers_to is not None
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    block = http if revisit else http + payload
    head = {
        "WARC-Type": "revisit" if revisit else "response", "WARC-Record-ID": f"<urn:page:{page}>", "WARC-Date": DATE,
        "WARC-Target-URI": quote(url or "", safe=":/?#[]@!$&'()*+,;=%~"),
        "Content-Type": "application/http;msgtype=response",
        "WARC-Payload-Digest": f"sha1:{base32_sha1(payload)}", "X-Payload-Length": str(len(payload)),
        "Content-Length": str(len(block))}
    if revisit:
        head |= {"WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 "WARC-Refers-To": f"<urn:page:{refers_to}>"}
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items())
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def parsed(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (lower-case names) and payload of a record."""
    top, _, rest = data.partition(b"\r\n\r\n")
    lines = top.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    head = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    block = rest[: int(head["content-length"])]
    return head, block.partition(b"\r\n\r\n")[2]


# --- packages: writing ------------------------------------------------------

class _Stream:
    """What ``zipfile`` needs of a file that can only be appended to."""

    def __init__(self, stream):
        self.stream = stream

    def write(self, data) -> int:
        self.stream.write(bytes(data))
        return len(data)

    def flush(self) -> None:
        pass


def _write_archive(folder: str, rows: Iterator[tuple], most: int) -> tuple[str, int, int] | None:
    """Writes up to ``most`` bytes of records; returns the archive, its records and bytes."""
    row = next(rows, None)
    if row is None:
        return None
    store, path = fs.FileSystem.from_uri(folder)
    name = f"{path}/{uuid.uuid4().hex}.wacz"
    index, at = [], 0
    with store.open_output_stream(name) as out, zipfile.ZipFile(_Stream(out), "w", zipfile.ZIP_STORED) as pack:
        with pack.open(zipfile.ZipInfo(DATA), "w", force_zip64=True) as member:
            while row is not None:
                data = gzip.compress(record(*row), 6, mtime=0)
                member.write(data)
                index.append(json.dumps({"offset": at, "length": len(data)}))
                at += len(data)
                row = next(rows, None) if at < most else None
        with pack.open(zipfile.ZipInfo(INDEX), "w", force_zip64=True) as member:
            member.write("\n".join(index).encode())
    return f"{folder}/{name.rpartition('/')[2]}", len(index), at


def _writer(folder: str, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (tuple(x.values()) for b in batches for x in b.to_pylist())
        while done := _write_archive(folder, rows, most):
            yield pa.RecordBatch.from_pylist([dict(zip(("archive", "records", "bytes"), done))])

    return run


def write_archives(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
                   min_bytes: int = 0, archive_bytes: int = 256 << 20) -> DataFrame:
    """Writes the pages; returns the manifest (archive, records, bytes)."""
    spark = pages.sparkSession
    folder = shared_dir(spark)
    store, path = fs.FileSystem.from_uri(folder)
    store.create_dir(path, recursive=True)
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(id_col).alias("page"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
    sha, size = F.sha1("payload"), F.octet_length("payload")
    last = (rows.select("page", sha.alias("sha"), size.alias("size")).filter(F.col("size") >= min_bytes)
            .groupBy("sha", "size").agg(F.max("page").alias("last"), F.count(F.lit(1)).alias("n")).filter("n > 1"))
    refers = F.when(~same(F.col("page"), F.col("last")), F.col("last"))
    ready = rows.join(last, (sha == F.col("sha")) & (size == F.col("size")), "left").select(
        "page", "url", "payload", refers.alias("refers_to"))
    return written(ready.mapInArrow(_writer(folder, archive_bytes), "archive string, records long, bytes long"))


# --- packages: reading ------------------------------------------------------

@dataclass(frozen=True)
class Member:
    """A stored member: its name, and where its bytes begin and how many they are."""

    name: str
    start: int
    size: int


class Package:
    """The directory of a ZIP archive read by byte range. ``read(start, size)``
    returns bytes; ``size`` is the archive's."""

    def __init__(self, read, size: int):
        self.read, self.size = read, size
        count, length, start = self._directory_place()
        self.entries = self._entries(read(start, length), count)

    def _directory_place(self) -> tuple[int, int, int]:
        """Entries, bytes and offset of the central directory."""
        tail_at = max(0, self.size - 65_557)
        tail = self.read(tail_at, self.size - tail_at)
        end = tail.rfind(b"PK\x05\x06")
        while end >= 0:  # a signature inside the comment doesn't fit the comment's length
            if end + 22 <= len(tail) and end + 22 + struct.unpack_from("<H", tail, end + 20)[0] == len(tail):
                break
            end = tail.rfind(b"PK\x05\x06", 0, end)
        if end < 0:
            raise ValueError("no end of central directory")
        count, length, start = struct.unpack_from("<HII", tail, end + 10)
        at = tail_at + end - 20
        if at >= 0:
            locator = self.read(at, 20)
            if locator[:4] == b"PK\x06\x07":
                record = self.read(struct.unpack_from("<Q", locator, 8)[0], 56)
                if record[:4] != b"PK\x06\x06":
                    raise ValueError("broken ZIP64 locator")
                count, length, start = struct.unpack_from("<QQQ", record, 32)
        return count, length, start

    @staticmethod
    def _entries(directory: bytes, count: int) -> dict[str, tuple[int, int, int]]:
        """name: (method, stored size, offset of the local header)."""
        found, at = {}, 0
        for _ in range(count):
            if directory[at : at + 4] != b"PK\x01\x02":
                raise ValueError("broken central directory")
            method, = struct.unpack_from("<H", directory, at + 10)
            packed, plain = struct.unpack_from("<II", directory, at + 20)
            n, extra, comment = struct.unpack_from("<HHH", directory, at + 28)
            offset, = struct.unpack_from("<I", directory, at + 42)
            name = directory[at + 46 : at + 46 + n].decode("utf-8", "replace")
            more, end = at + 46 + n, at + 46 + n + extra
            while more + 4 <= end:
                kind, size = struct.unpack_from("<HH", directory, more)
                if kind == 1:  # ZIP64: only the values that didn't fit, in this order
                    wide, place = directory[more + 4 : more + 4 + size], 0
                    if plain == 0xFFFFFFFF:
                        place += 8
                    if packed == 0xFFFFFFFF:
                        packed, = struct.unpack_from("<Q", wide, place)
                        place += 8
                    if offset == 0xFFFFFFFF:
                        offset, = struct.unpack_from("<Q", wide, place)
                more += 4 + size
            found[name] = (method, packed, offset)
            at = end + comment
        return found

    def member(self, name: str) -> Member:
        method, size, offset = self.entries[name]
        if method:
            raise ValueError(f"{name} is compressed; ranges need stored members")
        head = self.read(offset, 30)
        if head[:4] != b"PK\x03\x04":
            raise ValueError("broken local header")
        n, extra = struct.unpack_from("<HH", head, 26)
        return Member(name, offset + 30 + n + extra, size)


def records(uri: str) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and payload of every record of an archive, by range reads."""
    store, path = fs.FileSystem.from_uri(uri)
    with store.open_input_file(path) as f:
        read = lambda start, size: f.read_at(size, start)
        pack = Package(read, f.size())
        data, index = pack.member(DATA), pack.member(INDEX)
        for line in read(index.start, index.size).splitlines():
            place = json.loads(line)
            yield parsed(gzip.decompress(read(data.start + place["offset"], place["length"])))


def _reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ("page", "url", "payload_bytes", "payload_digest", "record_type", "refers_to")
    page = lambda x: x.removeprefix("<urn:page:").removesuffix(">")
    for batch in batches:
        for archive in batch["archive"].to_pylist():
            rows = []
            for head, payload in records(archive):
                kind, digest = head["warc-type"], head["warc-payload-digest"].removeprefix("sha1:")
                size = int(head["x-payload-length"])
                if kind == "response" and (size != len(payload) or digest != base32_sha1(payload)):
                    raise ValueError(f"payload of {head['warc-record-id']} differs from its digest")
                refers = head.get("warc-refers-to")
                rows.append((page(head["warc-record-id"]), head["warc-target-uri"], size, digest, kind,
                             refers and page(refers)))
                if len(rows) == 5000:
                    yield _rows(names, rows)
                    rows = []
            if rows:
                yield _rows(names, rows)


def _rows(names: tuple[str, ...], rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], list(names))


def read_archives(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """A row per record of the manifest's archives: page (text of its id, 'None'
    for null), url, payload_bytes, payload_digest, record_type, refers_to."""
    many = max(1, manifest.count())
    return manifest.select("archive").repartition(many).mapInArrow(
        _reader, "page string, url string, payload_bytes long, payload_digest string, record_type string, "
                 "refers_to string")
