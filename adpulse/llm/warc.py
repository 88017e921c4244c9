"""WARC archives as a Spark data source, and page tables archived with revisit records.

Writing: each task writes files of its own, one gzip member per record, and rolls them at a size. The driver commits the
finished files by listing them in a manifest, so that files of lost or repeated tasks are never read.

Reading: the planner deals whole files, small ones together, to partitions. Filters on the record type and on other
header columns are pushed into the reader. It decodes a record's header first; if a filter refuses the record, or no
payload is asked for, it goes on to the next record without decoding the rest: by the skip length in the gzip member's
extra field ("sl") or, in plain archives, by Content-Length. Members without skip length are decoded to be passed over.
"""

from __future__ import annotations

import json
import re
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from typing import Any

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualNullSafe,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNotNull,
    IsNull,
    LessThan,
    LessThanOrEqual,
    Not,
    StringContains,
    StringEndsWith,
    StringStartsWith,
    WriterCommitMessage,
)
from pyspark.sql.types import StructType

from adpulse.llm.common import shared_files, staged
from adpulse.session import scratch_path

SCHEMA = (
    "record_id string, record_type string, target_uri string, date string, content_type string, payload_digest string, "
    "refers_to string, content_length long, headers map<string,string>, payload binary, file string, position long"
)
# What a record to be written may have; headers holds further named fields.
WRITTEN = ("record_id", "record_type", "target_uri", "payload_digest", "refers_to", "headers", "payload")
# Header fields of the format behind the columns that are decoded from a header alone.
FIELDS = {
    "record_id": "WARC-Record-ID",
    "record_type": "WARC-Type",
    "target_uri": "WARC-Target-URI",
    "date": "WARC-Date",
    "content_type": "Content-Type",
    "payload_digest": "WARC-Payload-Digest",
    "refers_to": "WARC-Refers-To",
}
VERSION = b"WARC/1.1"
HTTP_TYPE = "application/http; msgtype=response"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
LENGTH_FIELD = "X-Payload-Length"
MANIFEST = "_committed.json"
FILE_BYTES = 256 << 20
PARTITION_BYTES = 128 << 20
BATCH_BYTES, BATCH_ROWS = 8 << 20, 1000
WINDOW_BYTES = 1 << 20
PUSHDOWN_CONF = "spark.sql.python.filterPushdown.enabled"
DATE = "1970-01-01T00:00:00Z"


# -- records -> bytes --------------------------------------------------------------------------------------------------


def _clean(value: str) -> str:
    """A header value on one line: control characters are percent-encoded."""
    return re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def encode_record(record: dict[str, Any], date: str = DATE) -> bytes:
    """One record. ``response`` and ``revisit`` records hold an HTTP message, a revisit without body; others hold their
    payload as it is."""
    kind = record.get("record_type") or "resource"
    payload = record.get("payload") or b""
    own = [(FIELDS[name], record[name]) for name in ("target_uri", "payload_digest", "refers_to") if record.get(name)]
    own += list(record.get("headers") or [])
    if kind in ("response", "revisit"):
        block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n" + (payload if kind == "response" else b"")
        content_type = HTTP_TYPE
    else:
        block, content_type = payload, "application/octet-stream"
    fields = [
        (FIELDS["record_type"], kind),
        (FIELDS["record_id"], record.get("record_id") or f"<urn:uuid:{uuid.uuid4()}>"),
        (FIELDS["date"], date),
        *own,
        ("Content-Type", content_type),
        ("Content-Length", str(len(block))),
    ]
    head = "".join(f"{name}: {_clean(value)}\r\n" for name, value in fields if value is not None)
    return VERSION + b"\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def gzip_member(data: bytes, level: int = 1) -> bytes:
    """A gzip member that names its own length and that of its content in an extra field."""
    squeezer = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = squeezer.compress(data) + squeezer.flush()
    head_size = 10 + 2 + 12
    extra = struct.pack("<H2sHII", 12, b"sl", 8, head_size + len(body) + 8, len(data) & 0xFFFFFFFF)
    head = b"\x1f\x8b\x08\x04\x00\x00\x00\x00\x00\xff" + extra
    return head + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


@dataclass
class _Written(WriterCommitMessage):
    files: list[str]


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options: dict[str, str], columns: Sequence[str], overwrite: bool) -> None:
        unknown = set(columns) - set(WRITTEN)
        if unknown:
            raise ValueError(f"WARC records have no columns {sorted(unknown)}; have {', '.join(WRITTEN)}")
        self._path, self._overwrite = options["path"].rstrip("/"), overwrite
        self._date = options.get("date", DATE)
        self._file_bytes = int(options.get("filebytes", FILE_BYTES))
        self._compressed = options.get("compressed", "true") == "true"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        files, folder = shared_files(self._path)
        files.create_dir(folder, recursive=True)
        names: list[str] = []
        out, size = None, 0
        try:
            for batch in iterator:
                for row in batch.to_pylist():
                    data = encode_record(row, self._date)
                    data = gzip_member(data) if self._compressed else data
                    if out is None or size + len(data) > self._file_bytes:
                        if out is not None:
                            out.close()
                        # A name of its own for each attempt: a task run twice never touches its twin's file.
                        names.append(f"part-{uuid.uuid4().hex}.warc" + ".gz" * self._compressed)
                        out, size = files.open_output_stream(f"{folder}/{names[-1]}", compression=None), 0
                    out.write(data)
                    size += len(data)
        finally:
            if out is not None:
                out.close()
        return _Written(names)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        files, folder = shared_files(self._path)
        files.create_dir(folder, recursive=True)
        before = committed_files(files, folder) or []
        names = [name for message in messages if message for name in message.files]
        kept = names if self._overwrite else [*before, *names]
        draft = f"{folder}/{MANIFEST}.{uuid.uuid4().hex}"
        with files.open_output_stream(draft) as out:
            out.write(json.dumps(kept).encode())
        files.move(draft, f"{folder}/{MANIFEST}")
        if self._overwrite:
            for name in before:
                files.delete_file(f"{folder}/{name}")

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        files, folder = shared_files(self._path)
        for message in messages:
            for name in message.files if message else ():
                files.delete_file(f"{folder}/{name}")


def committed_files(files: fs.FileSystem, folder: str) -> list[str] | None:
    """Names in the manifest; None where a folder has none, as archives of other writers."""
    if files.get_file_info(f"{folder}/{MANIFEST}").type == fs.FileType.NotFound:
        return None
    with files.open_input_stream(f"{folder}/{MANIFEST}") as source:
        return json.loads(source.read())


# -- bytes -> records --------------------------------------------------------------------------------------------------


class _Window:
    """Random access to a file through one buffered piece of it, so that short skips cost no read."""

    def __init__(self, source: pa.NativeFile) -> None:
        self._source, self.size = source, source.size()
        self._at, self._data = 0, b""

    def read(self, at: int, count: int) -> bytes:
        if not (self._at <= at and at + count <= self._at + len(self._data)):
            self._source.seek(min(at, self.size))
            self._at, self._data = at, self._source.read(max(count, WINDOW_BYTES))
        return self._data[at - self._at : at - self._at + count]


@dataclass
class RawRecord:
    """A record whose header is decoded; ``block()`` decodes the rest, which nobody has to call. ``next`` is called
    last and gives the place of the following record."""

    position: int
    headers: dict[str, str]
    block: Callable[[], bytes]
    next: Callable[[], int]


def _parse_headers(head: bytes, where: str) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"no WARC record at {where}")
    out: dict[str, str] = {}
    name = None
    for line in lines[1:]:
        if line[:1] in (" ", "\t") and name:  # a folded value
            out[name] += " " + line.strip()
        elif ":" in line:
            name, _, value = line.partition(":")
            name = name.strip()
            out[name] = value.strip()
    return out


def _skip_length(head: bytes) -> int | None:
    """The length of a gzip member from its extra field, if it names one."""
    if len(head) < 12 or not head[3] & 4:
        return None
    (total,) = struct.unpack_from("<H", head, 10)
    extra = head[12 : 12 + total]
    while len(extra) >= 4:
        (length,) = struct.unpack_from("<H", extra, 2)
        if extra[:2] == b"sl" and length >= 8:
            return struct.unpack_from("<I", extra, 4)[0]
        extra = extra[4 + length :]
    return None


class _Member:
    """Content of the gzip member at a place, decoded only as far as asked for."""

    def __init__(self, window: _Window, at: int) -> None:
        self._window, self._start, self._fed = window, at, at
        self._decoder, self.content = zlib.decompressobj(31), bytearray()
        self.known = _skip_length(window.read(at, 64))

    def grow(self) -> bool:
        """Decodes a bit more; False at the end of the member."""
        if self._decoder.eof:
            return False
        piece = self._window.read(self._fed, 4096)
        if not piece:
            raise ValueError(f"gzip member at byte {self._start} is cut off")
        self._fed += len(piece)
        self.content += self._decoder.decompress(piece)
        return True

    def end(self) -> int:
        following = self._start + (self.known or 0)
        if self.known and (following == self._window.size or self._window.read(following, 2) == b"\x1f\x8b"):
            return following
        while self.grow():
            self.content.clear()
        return self._fed - len(self._decoder.unused_data)


def raw_records(source: pa.NativeFile, name: str) -> Iterator[RawRecord]:
    window, at = _Window(source), 0
    while at < window.size:
        first = window.read(at, 2)
        if first == b"\x1f\x8b":
            member = _Member(window, at)
            while (cut := member.content.find(b"\r\n\r\n")) < 0 and member.grow():
                pass
            if cut < 0:
                raise ValueError(f"no WARC record at {name}:{at}")
            headers = _parse_headers(bytes(member.content[:cut]), f"{name}:{at}")
            length = int(_field(headers, "Content-Length") or 0)

            def block(member=member, start=cut + 4, length=length) -> bytes:
                while len(member.content) < start + length and member.grow():
                    pass
                return bytes(member.content[start : start + length])

            record = RawRecord(at, headers, block, member.end)
        elif first in (b"\r\n", b"\n\n"):  # between records of plain archives
            at += 2
            continue
        else:
            size = 4096
            while (cut := window.read(at, size).find(b"\r\n\r\n")) < 0:
                if at + size >= window.size:
                    raise ValueError(f"no WARC record at {name}:{at}")
                size *= 2
            headers = _parse_headers(window.read(at, cut), f"{name}:{at}")
            start, length = at + cut + 4, int(_field(headers, "Content-Length") or 0)
            record = RawRecord(
                at,
                headers,
                lambda start=start, length=length: window.read(start, length),
                lambda start=start, length=length: start + length,
            )
        yield record
        at = record.next()


def _field(headers: dict[str, str], name: str) -> str | None:
    if name in headers:
        return headers[name]
    return next((value for key, value in headers.items() if key.lower() == name.lower()), None)


def payload_of(headers: dict[str, str], block: bytes) -> bytes:
    """The body of an HTTP message, else the block."""
    if (_field(headers, "Content-Type") or "").startswith("application/http"):
        return block.partition(b"\r\n\r\n")[2]
    return block


# -- filters -----------------------------------------------------------------------------------------------------------

_TESTS: dict[type, Callable[[Any, Any], bool]] = {
    EqualTo: lambda own, value: own == value,
    GreaterThan: lambda own, value: own > value,
    GreaterThanOrEqual: lambda own, value: own >= value,
    LessThan: lambda own, value: own < value,
    LessThanOrEqual: lambda own, value: own <= value,
    In: lambda own, value: own in value,
    StringStartsWith: lambda own, value: own.startswith(value),
    StringEndsWith: lambda own, value: own.endswith(value),
    StringContains: lambda own, value: value in own,
}
HEADER_COLUMNS = (*FIELDS, "content_length")


def _column_of(wanted: Filter) -> str | None:
    inner = wanted.child if isinstance(wanted, Not) else wanted
    path = getattr(inner, "attribute", ())
    return path[0] if len(path) == 1 else None


def supported(wanted: Filter) -> bool:
    inner = wanted.child if isinstance(wanted, Not) else wanted
    if isinstance(inner, Not):
        return False
    return _column_of(wanted) in HEADER_COLUMNS and isinstance(inner, (*_TESTS, IsNull, IsNotNull, EqualNullSafe))


def holds(wanted: Filter, own: Any) -> bool:
    """Whether SQL would keep a row with this value: a comparison with null, negated or not, keeps none."""
    negated = isinstance(wanted, Not)
    inner = wanted.child if negated else wanted
    if isinstance(inner, IsNull):
        result = own is None
    elif isinstance(inner, IsNotNull):
        result = own is not None
    elif isinstance(inner, EqualNullSafe):
        result = own == inner.value
    elif own is None or inner.value is None or (isinstance(inner, In) and negated and None in inner.value):
        return False
    else:
        result = _TESTS[type(inner)](own, inner.value)
    return result != negated


# -- the data source ---------------------------------------------------------------------------------------------------


@dataclass
class _Files(InputPartition):
    names: list[str]


class WarcReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self._path = options["path"].rstrip("/")
        self._partition_bytes = int(options.get("partitionbytes", PARTITION_BYTES))
        self._with_payload = options.get("payload", "true") == "true"
        self._filters: list[Filter] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for wanted in filters:
            if supported(wanted):
                self._filters.append(wanted)
            else:
                yield wanted

    def partitions(self) -> Sequence[InputPartition]:
        """Whole files, the largest first; small ones share a partition."""
        files, folder = shared_files(self._path)
        info = files.get_file_info(folder)
        if info.type == fs.FileType.NotFound:
            raise FileNotFoundError(f"no archive at {self._path}")
        if info.type == fs.FileType.File:
            found = [info]
        else:
            names = committed_files(files, folder)
            if names is None:
                inside = files.get_file_info(fs.FileSelector(folder, recursive=True))
                found = [f for f in inside if f.path.endswith((".warc", ".warc.gz"))]
            else:
                found = files.get_file_info([f"{folder}/{name}" for name in names])
        out: list[_Files] = []
        size = 0
        for own in sorted(found, key=lambda f: (-f.size, f.path)):
            if not out or size + own.size > self._partition_bytes:
                out.append(_Files([]))
                size = 0
            out[-1].names.append(own.path)
            size += own.size
        return out or [_Files([])]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        files, _ = shared_files(self._path)
        rows: list[tuple] = []
        held = 0
        for name in partition.names:
            with files.open_input_file(name) as source:
                for record in raw_records(source, name):
                    row = self._row(record, name)
                    if row is None:
                        continue
                    rows.append(row)
                    held += 500 + len(row[9] or b"")
                    if held > BATCH_BYTES or len(rows) >= BATCH_ROWS:
                        yield _batch(rows)
                        rows, held = [], 0
        if rows:
            yield _batch(rows)

    def _row(self, record: RawRecord, name: str) -> tuple | None:
        length = int(_field(record.headers, "Content-Length") or 0)
        own = {column: _field(record.headers, field) for column, field in FIELDS.items()} | {"content_length": length}
        if not all(holds(wanted, own[_column_of(wanted)]) for wanted in self._filters):
            return None
        payload = payload_of(record.headers, record.block()) if self._with_payload else None
        return (*own.values(), list(record.headers.items()), payload, name, record.position)


_ARROW = pa.schema(
    [(name, pa.string()) for name in FIELDS]
    + [
        ("content_length", pa.int64()),
        ("headers", pa.map_(pa.string(), pa.string())),
        ("payload", pa.binary()),
        ("file", pa.string()),
        ("position", pa.int64()),
    ]
)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = [pa.array(column, kind) for column, kind in zip(zip(*rows), _ARROW.types, strict=True)]
    return pa.RecordBatch.from_arrays(columns, schema=_ARROW)


class WarcSource(DataSource):
    """``format("warc")``. Read options: ``payload`` (``false``: headers only), ``partitionBytes``. Write options:
    ``date`` of the records, ``fileBytes``, ``compressed``."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        return WarcReader(dict(self.options))

    def writer(self, schema: StructType, overwrite: bool) -> WarcWriter:
        return WarcWriter(dict(self.options), schema.names, overwrite)


def register(spark: SparkSession) -> None:
    """Makes the format known to the session and lets Spark push filters into Python sources."""
    spark.conf.set(PUSHDOWN_CONF, "true")
    spark.dataSource.register(WarcSource)


def read_warc(spark: SparkSession, path: str, payload: bool = True, **options: object) -> DataFrame:
    """Records of the archives at ``path`` (a file or a folder, plain or gzip). Filters on the columns of a header are
    pushed into the reader."""
    register(spark)
    return spark.read.format("warc").options(payload=str(payload).lower(), **options).load(path)


def write_warc(records: DataFrame, path: str, mode: str = "append", **options: object) -> None:
    register(records.sparkSession)
    records.write.format("warc").mode(mode).options(**options).save(path)


# -- pages ---------------------------------------------------------------------------------------------------------------

MIN_BYTES = 100


def _record_id(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("")), F.lit(">"))


def _page_id(record_id: Column) -> Column:
    return F.try_to_number(F.regexp_extract(record_id, "^<urn:page:(-?[0-9]+)>$", 1), F.lit("S" + "9" * 19)).cast("long")


def page_records(pages: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """One record per row of ``pages`` (page_id, url, html). Of rows with equal payloads (html in UTF-8) of at least
    ``min_bytes`` the one with the smallest page_id becomes a response, the others revisit it; smaller payloads are all
    responses.

    Payloads are compared by SHA-256 and length. Null html counts as empty, a null url leaves its field out. Rows
    without page_id come last: with each other only they are all responses. Rows alike in page_id and payload share
    their fate, so each of them is a response if their page_id is the smallest. Other columns are ignored.

    Digests are grouped without the payloads, copies combine map-side; the payloads move once, to meet the reference of
    their own row, by page and digest.
    """
    payload = F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8")
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("target_uri"), payload.alias("payload")
    ).withColumns({"digest": F.sha2("payload", 256), "size": F.octet_length("payload").cast("long")})
    narrow = staged(rows.where(F.col("size") >= min_bytes).select("page_id", "digest", "size"), "digests")
    firsts = (
        narrow.groupBy("digest", "size")
        .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1 and first is not null")
        .select("digest", "size", "first")
    )
    later = (
        narrow.join(firsts, ["digest", "size"])
        .where(F.col("page_id").isNull() | (F.col("page_id") > F.col("first")))
        .select(F.col("page_id").alias("own"), F.col("digest").alias("own_digest"), "first")
        .distinct()
    )
    same = F.col("page_id").eqNullSafe(F.col("own")) & (F.col("digest") == F.col("own_digest"))
    # A small payload never revisits, also where a digest's row is found.
    marked = rows.join(later, same, "left").withColumn("first", F.when(F.col("size") >= min_bytes, F.col("first")))
    revisits = F.col("first").isNotNull()
    fields = F.create_map(
        F.lit(LENGTH_FIELD), F.col("size").cast("string"), F.lit("WARC-Profile"), F.when(revisits, F.lit(REVISIT_PROFILE))
    )
    return marked.select(
        _record_id(F.col("page_id")).alias("record_id"),
        F.when(revisits, F.lit("revisit")).otherwise(F.lit("response")).alias("record_type"),
        "target_uri",
        F.concat(F.lit("sha256:"), F.col("digest")).alias("payload_digest"),
        F.when(revisits, _record_id(F.col("first"))).alias("refers_to"),
        fields.alias("headers"),
        F.when(~revisits, F.col("payload")).alias("payload"),
    )


def archive_pages(pages: DataFrame, path: str | None = None, min_bytes: int = MIN_BYTES, **options: object) -> str:
    """Writes ``page_records`` as archives below ``path`` (by default a new shared folder) and returns the path."""
    path = path or scratch_path(pages.sparkSession, "archive")
    write_warc(page_records(pages, min_bytes), path, **options)
    return path


def read_archived_pages(spark: SparkSession, path: str) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to, intact`` per record of ``archive_pages``.

    Of responses the payload is read and digested again; ``intact`` says whether that agrees with the header. Of
    revisits only the header is decoded, which names digest and length of the full payload.
    """
    stated = F.regexp_replace("payload_digest", "^sha256:", "")
    responses = read_warc(spark, path).where(F.col("record_type") == "response")
    revisits = read_warc(spark, path, payload=False).where(F.col("record_type") == "revisit")
    return responses.select(
        _page_id(F.col("record_id")).alias("page_id"),
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_digest"),
        "record_type",
        F.lit(None).cast("long").alias("refers_to"),
        (F.sha2("payload", 256) == stated).alias("intact"),
    ).unionByName(
        revisits.select(
            _page_id(F.col("record_id")).alias("page_id"),
            F.col("headers")[LENGTH_FIELD].cast("long").alias("payload_bytes"),
            stated.alias("payload_digest"),
            "record_type",
            _page_id(F.col("refers_to")).alias("refers_to"),
            F.lit(True).alias("intact"),
        )
    )
