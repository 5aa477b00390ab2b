"""WARC archives as a PySpark data source (``format("warc")``).

Writing. Every task writes files of its own; a record is a gzip member whose
header has the ``sl`` field of the WARC standard's gzip annex: the lengths
of the member and of the record. Files are rolled at ``roll_bytes``. The
commit lists the files of the tasks that succeeded, with places to split
them, in ``_manifest.jsonl``; what a lost or repeated task attempt has left
is not listed and so not read.

Reading. The partitions are the splits of the manifest (or whole files where
there is none; foreign archives, compressed or not, can be read, too). For
each record only the headers are decoded first. Filters on the header
columns are pushed down; a record that fails them, and any payload where the
option ``payload`` is ``false``, is skipped by its length without being
decoded. Filters that can't be pushed are left to Spark.

A payload is HTML in UTF-8 behind an HTTP header. A ``revisit`` record has
only the HTTP header, whose Content-Length tells the payload's length, and
refers to the record with the same payload.

Defined cases: null HTML is an empty payload; control characters and spaces
in a header's value are percent-encoded; a null id is written as ``null``.
"""

from __future__ import annotations

import io
import json
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    In,
    InputPartition,
    IsNotNull,
    StringStartsWith,
    WriterCommitMessage,
)

from billetic.llm._common import scratch, stored

MANIFEST = "_manifest.jsonl"
SCHEMA = ("record_type string, record_id string, target_uri string, payload_digest string, refers_to string, "
          "payload_bytes long, payload binary")
# Names of the format.
HEADERS = {"record_type": "warc-type", "record_id": "warc-record-id", "target_uri": "warc-target-uri",
           "payload_digest": "warc-payload-digest", "refers_to": "warc-refers-to"}
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


# -- files --------------------------------------------------------------------

def _filesystem(path: str):
    """pyarrow's file system of a path, and the path in it."""
    from pyarrow import fs

    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path)


def _open(path: str, buffer: int = 1 << 20):
    files, at = _filesystem(path)
    return io.BufferedReader(files.open_input_file(at), buffer)


# -- records ------------------------------------------------------------------

def _value(text) -> str:
    return "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in str(text))


def record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = ["WARC/1.1", *(f"{k}: {_value(v)}" for k, v in headers if v is not None),
             f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes, level: int = 4) -> bytes:
    """A gzip member with the lengths in its header."""
    packer = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = packer.compress(data) + packer.flush() + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)
    head = b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H", 12) + b"sl" + struct.pack("<H", 8)
    whole = len(head) + 8 + len(body)
    return head + struct.pack("<II", whole & 0xFFFFFFFF, len(data) & 0xFFFFFFFF) + body


def http_block(payload: bytes | None, length: int) -> bytes:
    return (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n"
            ).encode() + (payload or b"")


def _fields(lines: bytes) -> dict[str, str]:
    out = {}
    for line in lines.split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        out[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    return out


class _Member:
    """A record in a gzip member, decoded from the front as far as needed.
    Without the lengths in the header the end is found by decoding all."""

    def __init__(self, file):
        self.file, self.at = file, file.tell()
        head = file.read(10)
        self.size = None
        flags = head[3]
        if flags & 4:
            (n,) = struct.unpack("<H", file.read(2))
            extra = file.read(n)
            while len(extra) >= 4:
                (m,) = struct.unpack("<H", extra[2:4])
                if extra[:2] == b"sl" and m >= 8:
                    self.size = struct.unpack("<I", extra[4:8])[0]
                extra = extra[4 + m:]
        for bit in (8, 16):
            if flags & bit:
                while file.read(1) not in (b"\0", b""):
                    pass
        if flags & 2:
            file.read(2)
        self.unpack, self.data = zlib.decompressobj(-15), b""

    def _more(self) -> bool:
        if self.unpack.eof:
            return False
        part = self.unpack.unconsumed_tail or self.file.read(1 << 13)
        if not part:
            return False
        self.data += self.unpack.decompress(part, 1 << 16)
        return True

    def headers(self) -> bytes:
        while b"\r\n\r\n" not in self.data:
            if not self._more():
                raise ValueError("a record's headers don't end")
        lines, _, self.data = self.data.partition(b"\r\n\r\n")
        return lines

    def block(self, n: int, all_of_it: bool) -> bytes:
        """The record's block, or its beginning."""
        parts, have = [self.data], len(self.data)
        while have < n and all_of_it:
            self.data = b""
            if not self._more():
                raise ValueError("a record ends too early")
            parts.append(self.data)
            have += len(self.data)
        if not all_of_it:
            while b"\r\n\r\n" not in parts[0] and have < n and self._more():
                parts[0], have = self.data, len(self.data)
        return b"".join(parts)[:n]

    def skip(self) -> None:
        if self.size:
            self.file.seek(self.at + self.size)
            return
        while not self.unpack.eof:
            self.data = b""
            if not self._more():
                return
        self.file.seek(self.file.tell() - len(self.unpack.unused_data) + 8)


class _Plain:
    """A record in a file that is not compressed."""

    def __init__(self, file):
        self.file, self.end = file, None

    def headers(self) -> bytes:
        lines = []
        while (line := self.file.readline()) not in (b"\r\n", b"\n", b""):
            lines.append(line.rstrip(b"\r\n"))
        found = b"\r\n".join(lines)
        self.end = self.file.tell() + int(_fields(found).get("content-length", 0)) + 4
        return found

    def block(self, n: int, all_of_it: bool) -> bytes:
        return self.file.read(n if all_of_it else min(n, 1 << 14))

    def skip(self) -> None:
        self.file.seek(self.end)


# -- reading ------------------------------------------------------------------

@dataclass
class Split(InputPartition):
    path: str
    start: int
    end: int | None


class WarcReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path = options["path"].rstrip("/")
        self.payload = options.get("payload", "true").lower() != "false"
        self.tests: list[tuple[str, str, tuple]] = []

    def pushFilters(self, filters):
        for f in filters:
            name = f.attribute[0] if len(f.attribute) == 1 else None
            if name in HEADERS and isinstance(f, EqualTo):
                self.tests.append((name, "in", (f.value,)))
            elif name in HEADERS and isinstance(f, In):
                self.tests.append((name, "in", tuple(f.value)))
            elif name in HEADERS and isinstance(f, StringStartsWith):
                self.tests.append((name, "starts", (f.value,)))
            elif name in HEADERS and isinstance(f, IsNotNull):
                self.tests.append((name, "set", ()))
            else:
                yield f

    def partitions(self) -> list[Split]:
        files, root = _filesystem(self.path)
        from pyarrow import fs

        try:
            with files.open_input_stream(f"{root}/{MANIFEST}") as f:
                listed = [json.loads(line) for line in f.read().splitlines()]
        except FileNotFoundError:
            found = files.get_file_info(fs.FileSelector(root, recursive=True))
            return [Split(self.path + x.path[len(root):], 0, None) for x in sorted(found, key=lambda x: x.path)
                    if x.path.endswith((".warc", ".warc.gz"))]
        return [Split(f"{self.path}/{x['file']}", a, b) for x in listed
                for a, b in zip(x["splits"], x["splits"][1:], strict=False)]

    def _wanted(self, row: dict) -> bool:
        for name, how, values in self.tests:
            v = row[name]
            if v is None or how == "in" and v not in values or how == "starts" and not v.startswith(values[0]):
                return False
        return True

    def _rows(self, split: Split) -> Iterator[tuple]:
        with _open(split.path) as file:
            file.seek(split.start)
            while split.end is None or file.tell() < split.end:
                begin = file.peek(2)[:2]
                if not begin:
                    return
                rec = _Member(file) if begin == b"\x1f\x8b" else _Plain(file)
                fields = _fields(rec.headers())
                row = {c: fields.get(h) for c, h in HEADERS.items()}
                if row["payload_digest"]:
                    row["payload_digest"] = row["payload_digest"].rpartition(":")[2]
                if self._wanted(row):
                    size, payload = int(fields.get("content-length", 0)), None
                    whole = self.payload and row["record_type"] != "revisit"
                    block = rec.block(size, whole)
                    if fields.get("content-type", "").startswith("application/http"):
                        head, gap, rest = block.partition(b"\r\n\r\n")
                        n = _fields(head).get("content-length")
                        length = int(n) if n else size - len(head) - len(gap)
                    else:
                        rest, length = block, size
                    if whole:
                        payload = rest
                    yield (*row.values(), length, payload)
                rec.skip()

    def read(self, partition: Split | None) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string()] * 5 + [pa.int64(), pa.binary()]
        names = [*HEADERS, "payload_bytes", "payload"]

        def batch(rows):
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

        rows, size = [], 0
        for row in self._rows(partition) if partition else ():       # no files: one empty partition
            rows.append(row)
            size += len(row[-1] or b"") + 200
            if size > 8 << 20:
                yield batch(rows)
                rows, size = [], 0
        if rows:
            yield batch(rows)


# -- writing ------------------------------------------------------------------

@dataclass
class Written(WriterCommitMessage):
    files: list


class WarcWriter(DataSourceArrowWriter):
    """Rows (record_id, target_uri, payload_digest, refers_to, payload as
    string or binary, payload_bytes): a record with ``refers_to`` is a
    revisit."""

    def __init__(self, options: dict[str, str]):
        self.path = options["path"].rstrip("/")
        self.roll = int(options.get("roll_bytes", 64 << 20))
        self.split = int(options.get("split_bytes", 8 << 20))

    def _records(self, batches: Iterable[pa.RecordBatch]) -> Iterator[bytes]:
        for b in batches:
            for row in b.to_pylist():
                payload = row["payload"]
                payload = payload.encode() if isinstance(payload, str) else payload or b""
                again = row["refers_to"] is not None
                yield member(record([
                    ("WARC-Type", "revisit" if again else "response"),
                    ("WARC-Record-ID", row["record_id"]), ("WARC-Date", DATE),
                    ("WARC-Target-URI", row["target_uri"]),
                    ("WARC-Payload-Digest", f"sha1:{row['payload_digest']}"),
                    ("WARC-Refers-To", row["refers_to"]),
                    ("WARC-Profile", PROFILE if again else None),
                    ("Content-Type", "application/http;msgtype=response"),
                ], http_block(None if again else payload, row["payload_bytes"])))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        files, root = _filesystem(self.path)
        files.create_dir(root, recursive=True)
        done, out, at, splits, name = [], None, 0, [], ""
        for data in self._records(iterator):
            if out is None:
                name, at, splits = f"part-{uuid.uuid4().hex}.warc.gz", 0, [0]
                out = files.open_output_stream(f"{root}/{name}", compression=None)
            elif at - splits[-1] >= self.split:
                splits.append(at)
            out.write(data)
            at += len(data)
            if at >= self.roll:
                out.close()
                done.append({"file": name, "splits": [*splits, at]})
                out = None
        if out is not None:
            out.close()
            done.append({"file": name, "splits": [*splits, at]})
        return Written(files=done)

    def commit(self, messages) -> None:
        files, root = _filesystem(self.path)
        files.create_dir(root, recursive=True)
        listed = [f for m in messages if m for f in m.files]
        with files.open_output_stream(f"{root}/{MANIFEST}") as out:
            for f in sorted(listed, key=lambda f: f["file"]):
                out.write((json.dumps(f) + "\n").encode())

    def abort(self, messages) -> None:
        files, root = _filesystem(self.path)
        for f in (f for m in messages if m for f in m.files):
            files.delete_file(f"{root}/{f['file']}")


class Warc(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options)

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options)


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(Warc)


# -- the pages' archive -------------------------------------------------------

def _urn(page_id) -> F.Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("null")), F.lit(">"))


def _page_of(urn) -> F.Column:
    return F.regexp_extract(urn, r"^<urn:page:(-?\d+)>$", 1).try_cast("long")


def write_pages(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url",
                html_col: str = "html", min_bytes: int = 1000) -> None:
    """One record per row. Of rows with equal payloads of at least
    ``min_bytes`` those with the largest id are responses (rows without any
    id as well), the others revisits of it. Ids and digests alone decide;
    the HTML is moved at most once, to meet the decisions about payloads that
    occur more than once."""
    register(pages.sparkSession)
    html = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("target_uri"),
        html.alias("payload"), F.octet_length(html).cast("long").alias("payload_bytes"),
        F.sha1(html.cast("binary")).alias("payload_digest"))
    again = stored(
        rows.filter(F.col("payload_bytes") >= min_bytes).groupBy("payload_digest", "payload_bytes").agg(
            F.count(F.lit(1)).alias("n"), F.max("page_id").alias("first"))
        .filter("n > 1 and first is not null").select(
            F.col("payload_digest").alias("a_digest"), F.col("payload_bytes").alias("a_bytes"), "first"), "payloads")
    met = rows.join(again, (F.col("payload_digest") == F.col("a_digest"))
                    & (F.col("payload_bytes") == F.col("a_bytes")), "left")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    met.select(_urn(F.col("page_id")).alias("record_id"), "target_uri", "payload_digest",
               F.when(revisit, _urn(F.col("first"))).alias("refers_to"), "payload", "payload_bytes",
               ).write.format("warc").mode("append").save(path)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """``(page_id, payload_bytes, payload_digest, record_type, refers_to,
    url)`` of every record. Length and digest of responses are computed from
    the payloads read; those of revisits come from their headers."""
    register(spark)
    full = spark.read.format("warc").load(path).filter(F.col("record_type") == "response").select(
        "record_id", F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha1("payload").alias("payload_digest"), "record_type", "refers_to", "target_uri")
    bare = spark.read.format("warc").option("payload", "false").load(path).filter(
        F.col("record_type") == "revisit").select(
        "record_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "target_uri")
    return full.union(bare).select(
        _page_of(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        _page_of(F.col("refers_to")).alias("refers_to"), F.col("target_uri").alias("url"))


def round_trip(pages: DataFrame, **columns) -> DataFrame:
    path = scratch(pages.sparkSession, "warc")
    write_pages(pages, path, **columns)
    return read_pages(pages.sparkSession, path)
