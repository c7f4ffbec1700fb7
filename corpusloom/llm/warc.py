"""WARC archives as a PySpark data source.

Reading: ``partitions`` lists the files and deals them out by size. A reader
parses the header lines of each record first, holds them against the pushed
predicates, and steps over the block of a record that isn't wanted (a seek in a
plain file) without reading or decoding it. Files may be plain or have one gzip
member per record.

Writing: each task writes its own files, begins a new one at ``max_file_bytes``,
and commits by a rename. A task that runs again writes under another name, and
the driver keeps only the files of the attempts that Spark reports.

Paths go through Arrow's file systems, so they may be local to all machines
(``file:``) or in an object store that Arrow knows.
"""

from __future__ import annotations

import gzip
import io
import json
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceWriter,
    EqualTo,
    Filter,
    In,
    InputPartition,
    IsNotNull,
    StringStartsWith,
    WriterCommitMessage,
)

from corpusloom.operators.skew import salted_join
from corpusloom.scratch import Scratch

FORMAT = "warc"
LEAST_BYTES = 100
ROWS_PER_SLICE = 100_000
SCHEMA = (
    "record_type string, record_id string, target_uri string, date string, refers_to string, "
    "payload_digest string, payload_length bigint, content_type string, payload binary"
)
#: Column -> header line. Fixed names of WARC 1.1, but for the length of the full payload.
HEADERS = {
    "record_type": "WARC-Type",
    "record_id": "WARC-Record-ID",
    "target_uri": "WARC-Target-URI",
    "date": "WARC-Date",
    "refers_to": "WARC-Refers-To",
    "payload_digest": "WARC-Payload-Digest",
    "payload_length": "X-Payload-Length",
    "content_type": "Content-Type",
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _header_value(value: object) -> str:
    """No header value may hold a line end or other control character."""
    return re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", str(value))


def encode_record(row: dict) -> bytes:
    """One record: WARC headers, and for responses an HTTP header and the payload."""
    payload = row.get("payload")
    response = row["record_type"] == "response"
    body = bytes(payload) if payload is not None else b""
    if response:
        body = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(body) + body
    kind = row.get("content_type") or ("application/http; msgtype=response" if response else "application/octet-stream")
    lines = ["WARC/1.1"]
    for column, header in HEADERS.items():
        value = kind if column == "content_type" else row.get(column)
        if value is not None:
            lines.append(f"{header}: {_header_value(value)}")
    if row["record_type"] == "revisit":
        lines.append(f"WARC-Profile: {REVISIT_PROFILE}")
    lines.append(f"Content-Length: {len(body)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def _read_headers(stream) -> dict[str, str] | None:
    """The header lines of the next record, by lower-case name; None at the end of the file."""
    line = stream.readline()
    while line in (b"\r\n", b"\n"):
        line = stream.readline()
    if not line:
        return None
    if not line.startswith(b"WARC/"):
        raise ValueError(f"not a WARC record: {line[:60]!r}")
    out: dict[str, str] = {}
    while (line := stream.readline()) not in (b"\r\n", b"\n", b""):
        name, _, value = line.decode("utf-8", "replace").partition(":")
        out[name.strip().lower()] = value.strip()
    return out


def _skip(stream, length: int) -> None:
    if stream.seekable():
        stream.seek(length, io.SEEK_CUR)
        return
    while length > 0:
        length -= len(stream.read(min(length, 1 << 20)) or b" " * length)


def _payload(headers: dict[str, str], block: bytes) -> bytes:
    if "application/http" in headers.get("content-type", ""):
        return block.partition(b"\r\n\r\n")[2]
    return block


def read_records(stream, wanted, with_payload: bool = True) -> Iterator[tuple]:
    """Rows of a file whose headers pass ``wanted``; other blocks are stepped over."""
    while (headers := _read_headers(stream)) is not None:
        length = int(headers.get("content-length", 0))
        row = [headers.get(h.lower()) for h in HEADERS.values()]
        row[6] = int(row[6]) if row[6] is not None else None
        if not wanted(dict(zip(HEADERS, row, strict=True))):
            _skip(stream, length)
        elif with_payload:
            yield (*row, _payload(headers, stream.read(length)))
        else:
            _skip(stream, length)
            yield (*row, None)


@dataclass
class Files(InputPartition):
    paths: list[str]


@dataclass
class Written(WriterCommitMessage):
    renames: list[tuple[str, str]]


class WarcSource(DataSource):
    """Options: ``path``; ``payload`` (false: headers only); ``partition_bytes``,
    ``max_file_bytes`` and ``compression`` (none or gzip)."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options)

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        if overwrite:
            raise ValueError("write WARC files to a new folder, in mode append")
        return WarcWriter(self.options)


class WarcReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.partition_bytes = int(options.get("partition_bytes", 128 << 20))
        self.with_payload = str(options.get("payload", "true")).lower() != "false"
        self.tests: list[tuple[str, str, object]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Takes equality, IN, prefix and not-null tests of header columns; gives back the rest."""
        for f in filters:
            column = f.attribute[0] if hasattr(f, "attribute") and len(f.attribute) == 1 else None
            if column not in HEADERS:
                yield f
            elif isinstance(f, EqualTo):
                self.tests.append((column, "in", (f.value,)))
            elif isinstance(f, In):
                self.tests.append((column, "in", tuple(f.value)))
            elif isinstance(f, StringStartsWith):
                self.tests.append((column, "starts", f.value))
            elif isinstance(f, IsNotNull):
                self.tests.append((column, "known", None))
            else:
                yield f

    def wanted(self, row: dict) -> bool:
        for column, test, value in self.tests:
            have = row[column]
            if have is None:
                return False
            if test == "in" and have not in value or test == "starts" and not have.startswith(value):
                return False
        return True

    def partitions(self) -> list[Files]:
        """Whole files, dealt out so that each partition has about ``partition_bytes``."""
        system, root = fs.FileSystem.from_uri(self.path)
        found = system.get_file_info(fs.FileSelector(root, recursive=True))
        found = [f for f in found if f.is_file and re.search(r"\.warc(\.gz)?$", f.path) and "/_" not in f.path]
        out, room = [], 0
        for f in sorted(found, key=lambda f: f.path):
            if not out or room < f.size:
                out.append(Files([]))
                room = self.partition_bytes
            out[-1].paths.append(f.path)
            room -= f.size
        return out or [Files([])]

    def read(self, partition: Files) -> Iterator[tuple]:
        system, _ = fs.FileSystem.from_uri(self.path)
        for path in partition.paths:
            if path.endswith(".gz"):
                with system.open_input_stream(path, compression=None) as raw, gzip.GzipFile(fileobj=_Forward(raw)) as f:
                    # Members are unpacked one after another; a seek would unpack as well.
                    yield from read_records(_NoSeek(f), self.wanted, self.with_payload)
            else:
                with system.open_input_file(path) as raw, io.BufferedReader(raw, 1 << 16) as f:
                    yield from read_records(f, self.wanted, self.with_payload)


class _Forward(io.RawIOBase):
    """A forward-only stream for gzip."""

    def __init__(self, raw):
        self.raw = raw

    def readable(self) -> bool:
        return True

    def read(self, n: int = -1) -> bytes:
        return self.raw.read(n if n >= 0 else None)


class _NoSeek:
    def __init__(self, f):
        self.readline, self.read = f.readline, f.read

    def seekable(self) -> bool:
        return False


class WarcWriter(DataSourceWriter):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.max_file_bytes = int(options.get("max_file_bytes", 256 << 20))
        self.gzip = options.get("compression", "none") == "gzip"

    def write(self, iterator) -> Written:
        system, root = fs.FileSystem.from_uri(self.path)
        system.create_dir(f"{root}/_temporary", recursive=True)
        renames, out, size = [], None, 0
        try:
            for row in iterator:
                if out is None or size >= self.max_file_bytes:
                    if out is not None:
                        out.close()
                    name = f"{uuid.uuid4().hex}.warc" + ".gz" * self.gzip
                    out, size = system.open_output_stream(f"{root}/_temporary/{name}", compression=None), 0
                    renames.append((f"{root}/_temporary/{name}", f"{root}/{name}"))
                record = encode_record(row.asDict())
                if self.gzip:
                    pack = zlib.compressobj(3, zlib.DEFLATED, 31)
                    record = pack.compress(record) + pack.flush()
                out.write(record)
                size += len(record)
        finally:
            if out is not None:
                out.close()
        return Written(renames)

    def commit(self, messages: list[Written | None]) -> None:
        system, root = fs.FileSystem.from_uri(self.path)
        for message in messages:
            for old, new in message.renames if message else ():
                system.move(old, new)
        system.create_dir(root, recursive=True)
        with system.open_output_stream(f"{root}/_SUCCESS") as f:
            f.write(json.dumps({"files": sum(len(m.renames) for m in messages if m)}).encode())

    def abort(self, messages: list[Written | None]) -> None:
        system, _ = fs.FileSystem.from_uri(self.path)
        for message in messages:
            for old, _ in message.renames if message else ():
                system.delete_file(old)


def register(spark: SparkSession) -> None:
    """Make ``spark.read.format("warc")`` known, with predicates pushed to it."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


def records(
    pages: DataFrame,
    scratch: Scratch,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    least_bytes: int = LEAST_BYTES,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """A row for the writer per page.

    Of equal payloads of at least ``least_bytes``, the page with the smallest id
    is the response and the others revisit it, without a payload. Null html is
    an empty payload. Rows that repeat the smallest id are responses too; pages
    without an id revisit one that has an id, or are responses if none has.

    Equal payloads are found on ids and digests; a digest with very many pages
    is split. The saved list of revisits then meets the pages by id: where
    Spark measures it as small the payloads are not shuffled, else once.
    """
    flat = pages.select(
        F.col(id_col).alias("id"),
        F.col(url_col).cast("string").alias("target_uri"),
        F.encode(F.coalesce(F.col(html_col), F.lit("")), "UTF-8").alias("payload"),
    ).withColumn("digest", F.sha2("payload", 256))
    digests = flat.where(F.octet_length("payload") >= least_bytes).select("id", "digest")
    groups = scratch.save(
        digests.groupBy("digest")
        .agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > 1),
        "groups",
    )
    members = salted_join(digests, groups.select("digest", "first"), ["digest"], groups, F.col("id"), rows_per_slice)
    revisits = scratch.save(
        members.where(F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first")))
        .select(F.col("id").alias("_id"), F.col("digest").alias("_digest"), "first")
        .distinct(),
        "revisits",
    )
    met = flat.join(
        revisits, flat["id"].eqNullSafe(revisits["_id"]) & (flat["digest"] == revisits["_digest"]), "left"
    )
    revisit = F.col("first").isNotNull()
    name = lambda c: F.when(c.isNotNull(), F.concat(F.lit("<urn:page:"), c.cast("string"), F.lit(">")))
    return met.select(
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        name(F.col("id")).alias("record_id"),
        "target_uri",
        F.lit("2000-01-01T00:00:00Z").alias("date"),
        F.when(revisit, name(F.col("first"))).alias("refers_to"),
        F.concat(F.lit("sha256:"), "digest").alias("payload_digest"),
        F.octet_length("payload").cast("bigint").alias("payload_length"),
        F.lit(None).cast("string").alias("content_type"),
        F.when(~revisit, F.col("payload")).alias("payload"),
    )


def write_archive(rows: DataFrame, path: str, **options: object) -> None:
    register(rows.sparkSession)
    rows.write.format(FORMAT).options(**options).mode("append").save(path)


def read_archive(spark: SparkSession, path: str, **options: object) -> DataFrame:
    register(spark)
    return spark.read.format(FORMAT).options(**options).load(path)


def page_of(record_id):
    """The page id in a record id of ``records``."""
    return F.regexp_extract(record_id, "^<urn:page:(.*)>$", 1)
