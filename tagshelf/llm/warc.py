"""WARC archives as a Python data source: write records, and read them with pushed-down filters.

Every record is a gzip member of its own. Each task writes files of its own name, and
the commit of the job lists them, with the place of a record every so many bytes, in a
manifest; what a lost or repeated task leaves behind is in no manifest and is not read.

A reader plans ranges of files from the manifest, or whole files (``.warc``, ``.warc.gz``) where
there is none, as in archives that others wrote. Of each record it parses the WARC header first
and decodes the payload only where the record passes the filters on ``record_type`` and on
headers, and the payload is wanted.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, In,
                                    InputPartition, IsNotNull, WriterCommitMessage)
from pyspark.sql.types import StructType

from ..operators.lookup import lookup_join
from .common import by_value

by_value(__name__)

NAME = "warc"
MANIFEST = "_MANIFEST.json"
# A task starts a new file after so many bytes, and notes the place of a record every
# so many; ranges between noted places are what a reader's tasks are made of. Of a file at
# most so many places are noted, farther apart in a larger one: the driver lists them all.
FILE_BYTES = 1 << 30
RANGE_BYTES = 4 << 20
FILE_RANGES = 16
READ_BYTES = 1 << 20

# Columns that are headers of a record, by the name of the header.
HEADERS = {
    "record_type": "WARC-Type", "record_id": "WARC-Record-ID", "target_uri": "WARC-Target-URI",
    "date": "WARC-Date", "payload_digest": "WARC-Payload-Digest", "refers_to": "WARC-Refers-To",
    "payload_length": "WARC-Payload-Length",
}
SCHEMA = ", ".join(f"{c} string" for c in HEADERS) + ", payload binary"
WRITTEN = ("record_type", "record_id", "target_uri", "date", "payload_digest", "refers_to", "payload_length", "payload")
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"


def register(spark: SparkSession) -> None:
    """Make the format known to the session, and let it push filters down to it."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


def write_warc(records: DataFrame, path: str) -> None:
    """Write records with the columns ``WRITTEN`` (all strings, ``payload`` binary) to a new folder.

    A NULL header is left out. ``response`` records carry the payload behind an HTTP
    header; others carry none. No records give an archive without any.
    """
    register(records.sparkSession)
    records.select(*[F.col(c) for c in WRITTEN]).write.format(NAME).mode("append").save(path)


def read_warc(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """The records of an archive, a row each with the columns of ``SCHEMA``.

    Equality filters on ``record_type`` and the other header columns are pushed down. With
    ``payload=False`` no payload is decoded and the column is NULL, as it is for records
    with an empty block. Headers that a record lacks are NULL.

    The payload is the body of an HTTP message, or else the whole block, whatever the type of the
    record (``warcinfo``, ``metadata`` and others). A folder without a manifest may hold plain files
    and gzip files, with a record or several in a member; each is read by one task. A record without
    a length ends where its member does, or before the next record of a plain file. A file that ends
    within a record fails.
    """
    register(spark)
    return spark.read.format(NAME).option("payload", str(payload)).load(path)


def archive_pages(pages: DataFrame, path: str, min_bytes: int = 0) -> None:
    """Write a record per row of (page_id, url, html): ``response``, or ``revisit`` of an equal payload.

    The payload is the html in UTF-8; NULL is empty. Of records with equal payloads of
    ``min_bytes`` or more, that with the largest ``page_id`` is the response and the
    others refer to it; smaller ones are all responses. Of repeated rows with the largest
    ``page_id`` each is a response. A NULL ``page_id`` gives a record id without a number and
    is smaller than all others. Other columns are not read.
    """
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    kept = pages.select("page_id", "url", F.encode(html, "UTF-8").alias("payload"))
    rows = kept.withColumn("digest", base32(F.sha1("payload")))
    held = rows.filter(F.octet_length("payload") >= min_bytes).groupBy("digest").agg(
        F.max("page_id").alias("last_id"), F.count(F.lit(1)).alias("n"))
    marked = lookup_join(rows, held.filter("n > 1").select("digest", "last_id"), "digest", "left")
    revisit = F.col("last_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("last_id")) \
        & (F.octet_length("payload") >= min_bytes)
    write_warc(marked.select(
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        _urn("page_id").alias("record_id"), F.col("url").alias("target_uri"),
        F.lit("1970-01-01T00:00:00Z").alias("date"), F.concat(F.lit("sha1:"), "digest").alias("payload_digest"),
        F.when(revisit, _urn("last_id")).alias("refers_to"),
        F.octet_length("payload").cast("string").alias("payload_length"),
        F.when(~revisit, F.col("payload")).alias("payload")), path)


def _urn(column: str):
    return F.concat(F.lit("<urn:page:"), F.coalesce(F.col(column).cast("string"), F.lit("")), F.lit(">"))


def page_of(column: str):
    """The page id in a record id."""
    return F.regexp_extract(F.col(column), r"^<urn:page:(-?\d+)>$", 1).try_cast("long")


def base32(sha1_hex):
    """Upper-case base32 of 40 hexadecimal digits: each five of them are four digits of base 32."""
    fives = [F.lpad(F.conv(F.substring(sha1_hex, i, 5), 16, 32), 4, "0") for i in range(1, 41, 5)]
    return F.translate(F.concat(*fives), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


# ---- the format ------------------------------------------------------------

def open_folder(path: str) -> tuple[fs.FileSystem, str]:
    """A path of any file system that Arrow knows; without a scheme it is a local one."""
    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path)


class WarcSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> WarcReader:
        return WarcReader(self.options["path"], self.options.get("payload", "true").lower() == "true")

    def writer(self, schema: StructType, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options["path"])


@dataclass
class Written(WriterCommitMessage):
    files: list[tuple[str, list[int]]]


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, path: str):
        self.path = path

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        system, folder = open_folder(self.path)
        system.create_dir(folder, recursive=True)
        files: list[tuple[str, list[int]]] = []
        out, size, spacing = None, 0, RANGE_BYTES
        for batch in iterator:
            for row in batch.to_pylist():
                if out is None or size >= FILE_BYTES:
                    if out is not None:
                        files[-1][1].append(size)
                        out.close()
                    name = f"part-{uuid.uuid4().hex}.warc.gz"
                    files.append((name, [0]))
                    out, size = system.open_output_stream(f"{folder}/{name}", compression=None), 0
                    spacing = RANGE_BYTES
                places = files[-1][1]
                if size - places[-1] >= spacing:
                    places.append(size)
                    if len(places) > FILE_RANGES:
                        del places[1::2]
                        spacing *= 2
                member = compressed(record_bytes(row))
                out.write(member)
                size += len(member)
        if out is not None:
            files[-1][1].append(size)
            out.close()
        return Written(files)

    def commit(self, messages: list[Written | None]) -> None:
        system, folder = open_folder(self.path)
        system.create_dir(folder, recursive=True)
        listed = [f for m in messages if m for f in m.files]
        with system.open_output_stream(f"{folder}/{MANIFEST}", compression=None) as out:
            out.write(json.dumps(listed).encode())

    def abort(self, messages: list[Written | None]) -> None:
        system, folder = open_folder(self.path)
        for name, _ in [f for m in messages if m for f in m.files]:
            system.delete_file(f"{folder}/{name}")


def compressed(record: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(record) + packer.flush()


def record_bytes(row: dict) -> bytes:
    """One WARC/1.1 record."""
    payload = row["payload"]
    block = b"" if payload is None else _HTTP % len(payload) + payload
    lines = ["WARC/1.1"]
    lines += [f"{header}: {_one_line(row[c])}" for c, header in HEADERS.items() if row[c] is not None]
    if payload is not None:
        lines.append("Content-Type: application/http;msgtype=response")
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _one_line(value: str) -> str:
    return " ".join(value.splitlines()) if value.splitlines() != [value] else value


@dataclass
class Range(InputPartition):
    name: str
    start: int
    end: int


class WarcReader(DataSourceReader):
    def __init__(self, path: str, payload: bool):
        self.path = path
        self.payload = payload
        self.wanted: dict[str, set[str]] = {}

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for each in filters:
            name = each.attribute[0] if getattr(each, "attribute", None) else None
            if name in HEADERS and isinstance(each, (EqualTo, In)):
                values = {each.value} if isinstance(each, EqualTo) else set(each.value)
                self.wanted[name] = self.wanted.get(name, values) & values
            elif not (name in self.wanted and isinstance(each, IsNotNull)):
                yield each

    def partitions(self) -> Sequence[Range]:
        system, folder = open_folder(self.path)
        if system.get_file_info(f"{folder}/{MANIFEST}").type == fs.FileType.File:
            with system.open_input_stream(f"{folder}/{MANIFEST}", compression=None) as file:
                listed = json.loads(file.read())
        else:
            found = system.get_file_info(fs.FileSelector(folder, recursive=True))
            listed = [(f.path.removeprefix(folder).lstrip("/"), [0, f.size]) for f in sorted(found, key=lambda f: f.path)
                      if f.type == fs.FileType.File and f.size and f.path.endswith((".warc", ".warc.gz"))]
        return [Range(name, a, b) for name, places in listed for a, b in zip(places, places[1:])] or [Range("", 0, 0)]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        if not partition.name:
            return
        rows, size = [], 0
        for row in self.records(partition):
            rows.append(row)
            size += 200 + len(row["payload"] or b"")
            if size > READ_BYTES:
                yield self.batch(rows)
                rows, size = [], 0
        if rows:
            yield self.batch(rows)

    @staticmethod
    def batch(rows: list[dict]) -> pa.RecordBatch:
        kinds = [(c, pa.string()) for c in HEADERS] + [("payload", pa.binary())]
        return pa.RecordBatch.from_pylist(rows, pa.schema(kinds))

    def records(self, partition: Range) -> Iterator[dict]:
        system, folder = open_folder(self.path)
        with system.open_input_file(f"{folder}/{partition.name}") as file:
            file.seek(partition.start)
            left = partition.end - partition.start
            ahead = b""
            while left > 0 or ahead:
                member = (Member if partition.name.endswith(".gz") else Plain)(file, ahead, left)
                while member.has_record():
                    headers = member.headers()
                    row = {c: headers.get(h.lower()) for c, h in HEADERS.items()}
                    passed = all(row[c] in values for c, values in self.wanted.items())
                    length = headers.get("content-length")
                    block = member.block(int(length) if length and length.isdecimal() else None, passed and self.payload)
                    row["payload"] = payload_of(block, headers) if block else None
                    if passed:
                        yield row
                ahead, left = member.ahead, member.left


def payload_of(block: bytes, headers: dict[str, str]) -> bytes:
    if headers.get("content-type", "").lower().startswith("application/http"):
        head, found, body = block.partition(b"\r\n\r\n")
        return body if found else block
    return block


class Member:
    """One gzip member, inflated only as far as asked for. What is not wanted of it is passed in
    small pieces without being kept or decoded."""

    PIECE = 1 << 16

    def __init__(self, file, ahead: bytes, left: int):
        self.file, self.ahead, self.left = file, ahead, left
        self.inflate = zlib.decompressobj(31)
        self.found = bytearray()

    def ended(self) -> bool:
        return self.inflate.eof

    def more(self) -> None:
        """Some more of the member; nothing, if only its end was left."""
        if not self.ahead and self.left:
            self.ahead = self.file.read(min(self.PIECE, self.left))
            self.left -= len(self.ahead)
        data = self.inflate.decompress(self.ahead, self.PIECE)
        self.ahead = self.inflate.unused_data if self.inflate.eof else self.inflate.unconsumed_tail
        if not data and not self.ahead and not self.left and not self.inflate.eof:
            raise EOFError("a record ends early")
        self.found += data

    def has_record(self) -> bool:
        """Whether anything but line breaks is left; those are passed."""
        while True:
            kept = self.found.lstrip(b"\r\n")
            del self.found[:len(self.found) - len(kept)]
            if self.found or self.ended():
                return bool(self.found)
            self.more()

    def headers(self) -> dict[str, str]:
        while (end := self.found.find(b"\r\n\r\n")) < 0:
            if self.ended():
                raise EOFError("a record ends early")
            self.more()
        lines = self.found[:end].decode(errors="replace").split("\r\n")[1:]
        del self.found[:end + 4]
        return {name.strip().lower(): value.strip() for name, _, value in (line.partition(":") for line in lines)}

    def block(self, length: int | None, wanted: bool) -> bytes | None:
        """The block of a record of some length, if it is wanted; passed otherwise."""
        if length is None:
            return self.rest(wanted)
        if wanted:
            while len(self.found) < length:
                if self.ended():
                    raise EOFError("a record ends early")
                self.more()
            block = bytes(self.found[:length])
            del self.found[:length]
            return block
        while length > len(self.found):
            if self.ended():
                raise EOFError("a record ends early")
            length -= len(self.found)
            self.found.clear()
            self.more()
        del self.found[:length]
        return None

    def rest(self, wanted: bool) -> bytes | None:
        """The block of a record without a length: up to the end, or to the next record."""
        place = 0
        while (end := self.found.find(b"\r\n\r\nWARC/", place)) < 0 and not self.ended():
            place = max(0, len(self.found) - 8)
            self.more()
        end = end if end >= 0 else len(self.found)
        block = bytes(self.found[:end])
        del self.found[:end]
        return (block.removesuffix(b"\r\n\r\n") if wanted else None)


class Plain(Member):
    """A file that is not compressed, as if it were one member."""

    def ended(self) -> bool:
        return not self.left

    def more(self) -> None:
        piece = self.file.read(min(self.PIECE, self.left))
        if not piece:
            raise EOFError("a file ends early")
        self.left -= len(piece)
        self.found += piece
