"""WARC archives as a Spark data source: `spark.read.format("warc")` and `df.write.format("warc")`.

Files are planned into partitions by size. Each record's headers are parsed first; filters on the record type and the
other header columns are pushed down, and a record they reject, or whose payload is not asked for
(`payload` false), is passed over. Compressed records (a gzip member each) that carry their length in an `sl`
extra field, as the writer makes them, are passed over without inflating; others are inflated and dropped, uncompressed ones
are sought over.

Each task writes files of its own with unique names; only those of tasks that succeeded are moved into place. Nulls: a null header column is
no header; a null payload is an empty one."""

from __future__ import annotations

import base64
import hashlib
import posixpath
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote, unquote

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, In, InputPartition, WriterCommitMessage,
)
from pyspark.sql.types import StructType

from notesight.llm.common import staged

VERSION = b"WARC/1.1"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
SCHEMA = ("record_id string, record_type string, date string, target_uri string, refers_to string, payload_digest string, "
          "payload_bytes long, payload binary")
HEADERS = {  # column: header
    "record_id": "warc-record-id", "record_type": "warc-type", "date": "warc-date", "target_uri": "warc-target-uri",
    "refers_to": "warc-refers-to", "payload_digest": "warc-payload-digest",
}
PLAIN = "!#$&'()*+,/:;=?@[]~%<>{}|\\^`\" "  # kept as they are in header values; control characters are not


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


@dataclass
class Files(InputPartition):
    paths: tuple[str, ...]


class WarcSource(DataSource):
    """Options: `path`; `payload` (true): read payloads; `verify` (true): compare their digests;
    `partition_bytes`: small files share a partition up to this size; `compress` (true) and `file_bytes` when writing."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> WarcReader:
        return WarcReader(dict(self.options))

    def writer(self, schema: StructType, overwrite: bool) -> WarcWriter:
        return WarcWriter(dict(self.options), schema.names, overwrite)


class WarcReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.uri = options["path"]
        self.wanted = options.get("payload", "true").lower() == "true"
        self.verify = options.get("verify", "true").lower() == "true"
        self.partition_bytes = int(options.get("partition_bytes", 64 << 20))
        self.filters: list[tuple[str, frozenset]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            if isinstance(f, (EqualTo, In)) and len(f.attribute) == 1 and f.attribute[0] in HEADERS:
                values = [f.value] if isinstance(f, EqualTo) else f.value
                self.filters.append((f.attribute[0], frozenset(values)))
            else:
                yield f

    def partitions(self) -> list[Files]:
        system, root = pyarrow.fs.FileSystem.from_uri(self.uri)
        found = system.get_file_info(pyarrow.fs.FileSelector(root, recursive=False, allow_not_found=True))
        files = sorted((f.path, f.size) for f in found if f.is_file and f.path.endswith((".warc", ".warc.gz")))
        groups, size = [], 0
        for path, n in files:
            if not groups or size + n > self.partition_bytes:
                groups.append([])
                size = 0
            groups[-1].append(path)
            size += n
        return [Files(tuple(g)) for g in groups] or [Files(())]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        system, _ = pyarrow.fs.FileSystem.from_uri(self.uri)
        rows, held = [], 0
        for path in partition.paths:
            with system.open_input_file(path) as file:
                for row in records(file, path.endswith(".gz"), self._accepts, self.wanted, self.verify):
                    rows.append(row)
                    held += len(row[-1] or b"") + 500
                    if held > 8 << 20:
                        yield _batch(rows)
                        rows, held = [], 0
        yield _batch(rows)

    def _accepts(self, headers: dict[str, str]) -> bool:
        return all(column_of(headers, column) in values for column, values in self.filters)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.string()] * 6 + [pa.int64(), pa.binary()]
    columns = list(zip(*rows)) or [()] * 8
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], [f.split()[0] for f in SCHEMA.split(", ")])


def column_of(headers: dict[str, str], column: str) -> str | None:
    value = headers.get(HEADERS[column])
    if value is None:
        return None
    if column == "payload_digest":
        return value.removeprefix("sha1:")
    return value if column in ("record_type", "date") else unquote(value.strip("<>") if column != "target_uri" else value)


def records(file, compressed: bool, accepts, wanted: bool, verify: bool) -> Iterator[tuple]:
    """Rows of SCHEMA from one file."""
    for head, body in (_members(file) if compressed else _plain(file)):
        headers = parse_headers(head)
        if not accepts(headers):
            continue
        kind = headers.get("warc-type")
        http, payload, size = b"", None, None
        length = int(headers.get("content-length", 0))
        if headers.get("content-type", "").startswith("application/http"):
            http = body(1 << 16)
            end = http.find(b"\r\n\r\n")
            if end < 0:
                http = body(length)
                end = http.find(b"\r\n\r\n")
            inner = parse_headers(http[: max(end, 0)])
            size = int(inner["content-length"]) if "content-length" in inner else length - end - 4
            if wanted and kind != "revisit":
                payload = body(length)[end + 4 : length]
        elif wanted and kind != "revisit":
            payload, size = body(length)[:length], length
        else:
            size = length
        digest = column_of(headers, "payload_digest")
        if payload is not None and verify and digest and payload_digest(payload) != digest:
            raise ValueError(f"payload of {headers.get('warc-record-id')} does not match its digest")
        yield (*(column_of(headers, c) for c in HEADERS), size if payload is None else len(payload), payload)


def parse_headers(head: bytes) -> dict[str, str]:
    """Names in lower case; the first line is a version or status."""
    out = {}
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        name, colon, value = line.partition(":")
        if colon:
            out.setdefault(name.strip().lower(), value.strip())
    return out


def _plain(file) -> Iterator[tuple[bytes, object]]:
    """Headers and a function for the first n bytes of the block; blocks are sought over unless read."""
    size, at = file.size(), 0
    while at < size:
        file.seek(at)
        head = file.read(4096)
        end = head.find(b"\r\n\r\n")
        while end < 0 and at + len(head) < size:
            head += file.read(len(head))
            end = head.find(b"\r\n\r\n")
        if end < 0:
            if head.strip():
                raise ValueError("WARC record without an end of its headers")
            return
        start = at + end + 4
        length = int(parse_headers(head[:end]).get("content-length", 0))

        def body(n: int, start=start, length=length) -> bytes:
            file.seek(start)
            return file.read(min(n, length))

        yield head[:end], body
        at = start + length + 4


class _Member:
    """One gzip member, inflated only as far as asked for; what has been passed is let go."""

    def __init__(self, file, start: int, header: int, length: int | None):
        self.file, self.at, self.stop = file, start + header, None if length is None else start + length
        self.inflate = zlib.decompressobj(-15)
        self.out = b""

    def until(self, n: int) -> bytes:
        while len(self.out) < n and not self.inflate.eof:
            data = self.inflate.unconsumed_tail
            if not data:
                self.file.seek(self.at)
                data = self.file.read(1 << 16 if self.stop is None else min(1 << 16, self.stop - self.at))
                if not data:
                    raise ValueError("WARC member cut off")
                self.at += len(data)
            self.out += self.inflate.decompress(data, max(n - len(self.out), 1 << 12))
        return self.out

    def skip(self, n: int) -> bool:
        """Pass over n bytes; whether a record follows, with nothing but line ends before it."""
        while n > len(self.out) and not self.inflate.eof:
            n -= len(self.out)
            self.out = b""
            self.until(min(n, 1 << 16))
        self.out = self.out[n:]
        while not (rest := self.until(4).lstrip(b"\r\n")) and not self.inflate.eof:
            self.out = b""
        self.out = self.out.lstrip(b"\r\n")
        return bool(rest)

    def end(self) -> int:
        """Where the next member starts, inflating the rest only if the length is unknown."""
        if self.stop is not None:
            return self.stop
        while not self.inflate.eof:
            self.out = b""
            self.until(1 << 16)
        return self.at - len(self.inflate.unused_data) + 8  # after the sum and size


def _members(file) -> Iterator[tuple[bytes, object]]:
    """Headers and a function for the first n bytes of the block, of each record of each member. A member that states its
    whole size is left after its last record without inflating more."""
    size, at = file.size(), 0
    while at < size:
        file.seek(at)
        start = file.read(4096)
        header, length, whole = _gzip_header(start)
        member, more, passed = _Member(file, at, header, length), True, 0
        while more:
            n = 2048
            while (end := member.until(n).find(b"\r\n\r\n")) < 0 and not member.inflate.eof:
                n *= 2
            if end < 0:
                raise ValueError("WARC record without an end of its headers")

            def body(n: int, member=member, end=end) -> bytes:
                return member.until(end + 4 + n)[end + 4 : end + 4 + n]

            head = member.out[:end]
            yield head, body
            record = end + 4 + int(parse_headers(head).get("content-length", 0)) + 4
            passed += record
            more = (whole is None or passed < whole) and member.skip(record)
        at = member.end()


def _gzip_header(data: bytes) -> tuple[int, int | None, int | None]:
    """Its length, and the lengths of the member and of what it inflates to if an `sl` field says them."""
    if data[:3] != b"\x1f\x8b\x08":
        raise ValueError("not a gzip member")
    flags, at, length, whole = data[3], 10, None, None
    if flags & 4:
        (n,) = struct.unpack_from("<H", data, at)
        field, at = data[at + 2 : at + 2 + n], at + 2 + n
        while len(field) >= 4:
            (m,) = struct.unpack_from("<H", field, 2)
            if field[:2] == b"sl" and m == 8:
                length, whole = struct.unpack_from("<II", field, 4)
            field = field[4 + m :]
    for flag in (8, 16):  # name, comment
        if flags & flag:
            at = data.index(b"\0", at) + 1
    return at + 2 * bool(flags & 2), length or None, whole if length else None


@dataclass
class Written(WriterCommitMessage):
    paths: tuple[str, ...]


class WarcWriter(DataSourceArrowWriter):
    """Rows of record_id, record_type, target_uri, refers_to, payload_digest, payload_bytes, payload (date optional)."""

    def __init__(self, options: dict[str, str], names: list[str], overwrite: bool):
        self.uri, self.names = options["path"], names
        self.compress = options.get("compress", "true").lower() == "true"
        self.file_bytes = int(options.get("file_bytes", 128 << 20))
        if overwrite:
            raise ValueError("archives are only added to: use mode append and a folder of its own")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        system, root = pyarrow.fs.FileSystem.from_uri(self.uri)
        waiting = posixpath.join(root, "_waiting")
        system.create_dir(waiting, recursive=True)
        done, out, written = [], None, 0
        for batch in iterator:
            columns = {c: batch.column(i) for i, c in enumerate(batch.schema.names)}
            for i in range(batch.num_rows):
                if out is None:
                    done.append(f"{waiting}/{uuid.uuid4().hex}.warc" + ".gz" * self.compress)
                    out, written = system.open_output_stream(done[-1], compression=None), 0
                data = record({c: v[i].as_py() for c, v in columns.items()})
                data = member(data) if self.compress else data
                out.write(data)
                written += len(data)
                if written >= self.file_bytes:
                    out.close()
                    out = None
        if out is not None:
            out.close()
        return Written(tuple(done))

    def commit(self, messages: list[Written | None]) -> None:
        system, root = pyarrow.fs.FileSystem.from_uri(self.uri)
        for message in messages:
            for path in message.paths if message else ():
                system.move(path, posixpath.join(root, posixpath.basename(path)))

    def abort(self, messages: list[Written | None]) -> None:
        system, _ = pyarrow.fs.FileSystem.from_uri(self.uri)
        for message in messages:
            for path in message.paths if message else ():
                system.delete_file(path)


def record(row: dict) -> bytes:
    """One record. A revisit has the HTTP headers alone, which still say the length of the payload."""
    revisit = row["record_type"] == "revisit"
    payload = row.get("payload") or b""
    size = row.get("payload_bytes") if revisit else len(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size or 0}\r\n\r\n".encode()
    block = http if revisit else http + payload
    headers = [
        ("WARC-Type", row["record_type"]),
        ("WARC-Record-ID", f"<{quote(row['record_id'], safe=PLAIN.replace('%', ''))}>"),
        ("WARC-Date", row.get("date") or "1970-01-01T00:00:00Z"),
        ("WARC-Target-URI", row.get("target_uri") and quote(row["target_uri"], safe=PLAIN.replace("%", ""))),
        ("WARC-Payload-Digest", row.get("payload_digest") and f"sha1:{row['payload_digest']}"),
        ("WARC-Refers-To", row.get("refers_to") and f"<{quote(row['refers_to'], safe=PLAIN.replace('%', ''))}>"),
        ("WARC-Profile", REVISIT if revisit else None),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    head = "".join(f"{name}: {value}\r\n" for name, value in headers if value)
    return VERSION + b"\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def member(data: bytes, level: int = 6) -> bytes:
    """A gzip member with its length in an extra field."""
    deflate = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = deflate.compress(data) + deflate.flush()
    length = 24 + len(body) + 8
    head = b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H2sHII", 12, b"sl", 8, length, len(data) & 0xFFFFFFFF)
    return head + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


def register(spark: SparkSession) -> None:
    """Make the format known to the session, with filter pushdown for Python sources."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


def write(records_of: DataFrame, folder: str, **options: object) -> None:
    register(records_of.sparkSession)
    records_of.write.format("warc").mode("append").options(path=folder, **options).save()


def read(spark: SparkSession, folder: str, **options: object) -> DataFrame:
    register(spark)
    return spark.read.format("warc").options(path=folder, **options).load()


def digest_column(payload: Column) -> Column:
    """`payload_digest` as a column: twenty bits at a time from base 16 to base 32."""
    sha1 = F.sha1(payload)
    digits = [F.lpad(F.conv(F.substring(sha1, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*digits), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def archived(pages: DataFrame, page_id: str, uri: str, html: str, least: int = 0) -> DataFrame:
    """Rows for `write`, one per page. Of pages with equal payloads of at least `least` bytes those with the
    smallest id are responses and the others revisits of it; a null id is larger than any.

    Only the digests that occur twice or more are joined back: payloads stay where they are if that list
    is small, and a hot digest's rows are split by Spark if not."""
    payload = F.coalesce(html, F.lit(""))
    pages = pages.select(
        F.col(page_id).alias("page_id"), F.col(uri).alias("target_uri"), F.encode(payload, "UTF-8").alias("payload"),
        digest_column(payload).alias("payload_digest"), F.octet_length(payload).cast("long").alias("payload_bytes"),
    )
    groups = pages.filter(F.col("payload_bytes") >= least).groupBy("payload_digest")
    repeated = staged(
        groups.agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"), "revisits"
    )
    name = lambda c: F.concat(F.lit("urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("")))
    first = F.col("first_id").isNull() | F.col("page_id").eqNullSafe(F.col("first_id")) | (F.col("payload_bytes") < least)
    return pages.join(repeated, "payload_digest", "left").select(
        name("page_id").alias("record_id"),
        F.when(first, "response").otherwise("revisit").alias("record_type"),
        "target_uri",
        F.when(~first, name("first_id")).alias("refers_to"),
        "payload_digest",
        "payload_bytes",
        F.when(first, F.col("payload")).alias("payload"),
    )


def page_of(record_id: str) -> Column:
    """The page id in a record id that `archived` made."""
    return F.nullif(F.substring_index(record_id, ":", -1), F.lit("")).cast("long")
