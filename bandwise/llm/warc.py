"""WARC archives as a PySpark Python data source (``format("warc")``).

Writing: every task writes its own files, one gzip member per record, and the
driver's commit lists the files of the tasks that count, so a task that runs
again leaves nothing that is read. Reading: files are planned into partitions
of about ``partition_bytes``; filters on the header columns are pushed down and
decided on a record's headers, before its block is touched; blocks that aren't
wanted are passed over without being parsed or decoded.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, EqualNullSafe,
                                    EqualTo, In, InputPartition, IsNotNull, StringStartsWith,
                                    WriterCommitMessage)
from pyspark.sql.pandas.types import to_arrow_schema

READ_SCHEMA = ("record_id string, record_type string, target_uri string, refers_to string, "
               "payload_digest string, payload_bytes long, payload binary")
#: Columns decided by the headers alone, and the WARC header of each.
HEADERS = {"record_id": "warc-record-id", "record_type": "warc-type", "target_uri": "warc-target-uri",
           "refers_to": "warc-refers-to", "payload_digest": "warc-payload-digest"}
MANIFEST = "_files.json"
#: Names that the writer gives.
OWN = re.compile(r"part-[0-9a-f]{32}\.warc\.gz$")
#: Records carry this date where the rows name none: equal input gives equal archives.
DATE = "1970-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _open(path: str):
    """(filesystem, path in it) of a URI or a local path."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def _header_value(value: str) -> str:
    return " ".join(value.split())


def base32_digest(hex_digest: str) -> str:
    return base64.b32encode(bytes.fromhex(hex_digest)).decode()


def record_bytes(row: dict) -> bytes:
    """One record: HTTP response headers, and the payload unless it is a revisit."""
    payload = row["payload"] or b""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {row['payload_bytes']}\r\n\r\n").encode()
    revisit = row["record_type"] == "revisit"
    block = http if revisit else http + payload
    head = [f"WARC-Type: {row['record_type']}", f"WARC-Record-ID: {row['record_id']}", f"WARC-Date: {DATE}",
            "Content-Type: application/http; msgtype=response",
            f"WARC-Payload-Digest: sha1:{row['payload_digest']}"]
    if row["target_uri"]:
        head.append(f"WARC-Target-URI: {_header_value(row['target_uri'])}")
    if revisit:
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {row['refers_to']}"]
    head.append(f"Content-Length: {len(block)}")
    return ("WARC/1.1\r\n" + "\r\n".join(head) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def _listed(fs, path: str, unlisted: bool = True) -> list:
    """Names and sizes of a folder's archives: those of its list, or of a folder without one all that
    are there (without ``unlisted`` only those that no writer of this module made)."""
    from pyarrow.fs import FileSelector, FileType

    if fs.get_file_info(f"{path}/{MANIFEST}").type == FileType.File:
        with fs.open_input_stream(f"{path}/{MANIFEST}", compression=None) as f:
            return [[name, size] for name, size in json.loads(f.read())]
    return sorted([i.base_name, i.size] for i in fs.get_file_info(FileSelector(path))
                  if i.type == FileType.File and i.base_name.endswith((".warc", ".warc.gz"))
                  and (unlisted or not OWN.match(i.base_name)))


@dataclass
class Written(WriterCommitMessage):
    files: list


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options, overwrite: bool):
        self.path, self.overwrite = options["path"].rstrip("/"), overwrite
        self.file_bytes = int(options.get("file_bytes", 128 << 20))
        self.level = int(options.get("compression_level", 1))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, path = _open(self.path)
        fs.create_dir(path)
        files, out, size = [], None, 0
        for batch in iterator:
            names = batch.schema.names
            for values in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None or size >= self.file_bytes:
                    if out is not None:
                        out.close()
                    files.append([f"part-{uuid.uuid4().hex}.warc.gz", 0])
                    out, size = fs.open_output_stream(f"{path}/{files[-1][0]}", compression=None), 0
                    out.write(gzip.compress(b"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:"
                                            + str(uuid.uuid4()).encode() + b">\r\nWARC-Date: " + DATE.encode()
                                            + b"\r\nContent-Length: 0\r\n\r\n\r\n\r\n", self.level))
                member = gzip.compress(record_bytes(dict(zip(names, values))), self.level, mtime=0)
                out.write(member)
                size += len(member)
                files[-1][1] = size
        if out is not None:
            out.close()
        return Written(files)

    def commit(self, messages) -> None:
        fs, path = _open(self.path)
        fs.create_dir(path)
        listed = sorted(f for m in messages if m is not None for f in m.files)
        if not self.overwrite:
            listed = _listed(fs, path, unlisted=False) + listed  # one writer at a time appends
        with fs.open_output_stream(f"{path}/{MANIFEST}", compression=None) as out:
            out.write(json.dumps(listed).encode())

    def abort(self, messages) -> None:
        """Nothing to undo: files that no manifest lists are not read."""


@dataclass
class Files(InputPartition):
    paths: list


class WarcReader(DataSourceReader):
    def __init__(self, schema, options):
        self.columns = list(schema.names)
        self.arrow = to_arrow_schema(schema)
        self.path = options["path"].rstrip("/")
        self.partition_bytes = int(options.get("partition_bytes", 64 << 20))
        self.verify = options.get("verify", "false").lower() == "true"
        self.tests: list[tuple] = []

    def pushFilters(self, filters):
        """Equality, sets, prefixes and presence of header columns are decided here; the rest by Spark."""
        for f in filters:
            kind = {EqualTo: "eq", EqualNullSafe: "eq", In: "in", StringStartsWith: "starts", IsNotNull: "there"}.get(type(f))
            if kind and f.attribute[0] in HEADERS and len(f.attribute) == 1:
                self.tests.append((f.attribute[0], kind, getattr(f, "value", None)))
            else:
                yield f

    def partitions(self):
        fs, path = _open(self.path)
        found = _listed(fs, path)
        parts, size = [], 0
        for name, n in found:
            if not parts or size + n > self.partition_bytes:
                parts.append(Files([]))
                size = 0
            parts[-1].paths.append(name)
            size += n
        return parts or [Files([])]

    def _wanted(self, header: dict) -> bool:
        for column, kind, value in self.tests:
            have = header.get(column)
            if have is None:
                if not (kind == "eq" and value is None):
                    return False
            elif kind == "eq" and have != value or kind == "in" and have not in value \
                    or kind == "starts" and not have.startswith(value):
                return False
        return True

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        fs, path = _open(self.path)
        rows, size = [], 0
        for name in partition.paths:
            with fs.open_input_stream(f"{path}/{name}", compression=None) as raw:
                stream = io.BufferedReader(gzip.GzipFile(fileobj=raw) if name.endswith(".gz") else raw, 1 << 16)
                for header, block in records(stream, self._wanted):
                    rows.append(self._row(header, block))
                    size += len(block)
                    if len(rows) >= 1000 or size >= 8 << 20:
                        yield self._batch(rows)
                        rows, size = [], 0
        if rows:
            yield self._batch(rows)

    def _row(self, header: dict, block: bytes) -> dict:
        """Block needed only for what the caller's schema asks."""
        if not {"payload", "payload_bytes"} & set(self.columns):
            return header
        head, _, body = block.partition(b"\r\n\r\n")
        length = next((int(v) for k, _, v in (x.partition(b":") for x in head.split(b"\r\n"))
                       if k.strip().lower() == b"content-length"), None)
        revisit = header.get("record_type") == "revisit"
        if not revisit and (length is not None and length != len(body) or self.verify and header.get(
                "payload_digest") != base64.b32encode(hashlib.sha1(body).digest()).decode()):
            raise ValueError(f"payload of {header.get('record_id')} doesn't match its headers")
        return header | {"payload": None if revisit else body, "payload_bytes": length if revisit else len(body)}

    def _batch(self, rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([r.get(f.name) for r in rows], f.type) for f in self.arrow], schema=self.arrow)


def records(stream: io.BufferedReader, wanted) -> Iterator[tuple[dict, bytes]]:
    """(header columns, block) of the records whose headers are wanted; other blocks are passed over."""
    named = {v: k for k, v in HEADERS.items()}
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record begins with {line[:40]!r}")
        header, length = {}, 0
        while (line := stream.readline().strip()):
            key, _, value = line.decode("utf-8", "replace").partition(":")
            key, value = key.strip().lower(), value.strip()
            if key == "content-length":
                length = int(value)
            elif key in named:
                header[named[key]] = value.removeprefix("sha1:") if key == "warc-payload-digest" else value
        if wanted(header):
            yield header, stream.read(length)
        else:
            while length > 0 and (passed := len(stream.read(min(length, 1 << 20)))):
                length -= passed


class WarcDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return READ_SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(schema, self.options)

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options, overwrite)


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcDataSource)


def read_warc(spark: SparkSession, path: str, columns: str = READ_SCHEMA, **options) -> DataFrame:
    """Records of an archive folder. ``columns`` names those wanted: without payload and
    payload_bytes no block is parsed. ``verify="true"`` checks payloads against their digests."""
    register(spark)
    return spark.read.format("warc").schema(columns).options(**options).load(path)


def write_warc(records: DataFrame, path: str, **options) -> None:
    """Archives of rows with the columns of ``READ_SCHEMA``, into a new folder."""
    register(records.sparkSession)
    records.write.format("warc").mode("append").options(**options).save(path)


def page_records(pages: DataFrame, first_pages, min_revisit_bytes: int = 0) -> DataFrame:
    """A record per row of ``pages`` (page_id, url, html): of equal payloads the smallest page_id responds,
    the others revisit it.

    ``first_pages`` turns the small table of repeated payloads (digest, length, first) into one
    that is evaluated once (``common.written``). Null html is an empty payload. A null
    page_id has the record id ``<urn:page:>`` and is never a first page; repeated rows of a first page all respond.
    Payloads under ``min_revisit_bytes`` always respond. Other columns are ignored.
    """
    slim = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"))
    slim = slim.withColumns({"digest": F.sha1("payload"), "length": F.length("payload").cast("long")})
    repeated = first_pages(slim.where(F.col("length") >= min_revisit_bytes).groupBy("digest", "length").agg(
        F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1 and first is not null")
        .select("digest", "length", "first"))
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    bare = slim.join(repeated, ["digest", "length"], "left")
    return bare.select(
        urn(F.col("page_id")).alias("record_id"),
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.col("url").alias("target_uri"), F.when(revisit, urn(F.col("first"))).alias("refers_to"),
        base32("digest").alias("payload_digest"), F.col("length").alias("payload_bytes"),
        F.when(~revisit, F.col("payload")).alias("payload"))


def base32(hex_column: str):
    """Upper-case base32 of a 40-digit hexadecimal column: each five digits are four letters of five bits."""
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    bits = F.concat(*[F.lpad(F.conv(F.substring(hex_column, 5 * i + 1, 5), 16, 2), 20, "0") for i in range(8)])
    alphabet = F.lit(letters)
    return F.concat(*[F.substring(alphabet, F.conv(F.substring(bits, 5 * i + 1, 5), 2, 10).cast("int") + 1,
                                  F.lit(1)) for i in range(32)])
