"""WARC archives as a Python data source: writer, planned reader with pushed-down predicates."""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import struct
import zlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In,
    InputPartition, IsNotNull, IsNull, LessThan, LessThanOrEqual, StringContains, StringEndsWith, StringStartsWith,
    WriterCommitMessage,
)

SCHEMA = (
    "record_id string, record_type string, target_uri string, date string, refers_to string, payload_digest string, "
    "content_type string, content_length long, headers map<string,string>, payload_bytes long, payload binary, file string, offset long"
)
# Header of each column that comes straight from one.
HEADERS = {
    "record_id": "warc-record-id", "record_type": "warc-type", "target_uri": "warc-target-uri", "date": "warc-date",
    "refers_to": "warc-refers-to", "payload_digest": "warc-payload-digest", "content_type": "content-type",
    "content_length": "content-length",
}
MANIFEST = "_manifest.json"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
FILE_BYTES = 1 << 30
HEAD = 4096
BATCH_BYTES = 8 << 20


def place(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a URI or a plain path."""
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def payload_digest(payload: bytes) -> str:
    """Bare upper-case base32 of the SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _clean(value: str) -> str:
    """A header value on one line."""
    return value.replace("\r", "%0D").replace("\n", "%0A")


# Writing


def record(values: dict, date: str) -> bytes:
    """One record: headers, then an HTTP response; a revisit has the response's headers only."""
    payload = values["payload"] or b""
    revisit = values["record_type"] == "revisit"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    lines = [
        "WARC/1.1", f"WARC-Type: {values['record_type']}", f"WARC-Record-ID: {_clean(values['record_id'] or '')}", f"WARC-Date: {date}",
        f"WARC-Target-URI: {_clean(values['target_uri'] or '')}", f"WARC-Payload-Digest: sha1:{payload_digest(payload)}",
    ]
    if revisit:
        lines += [f"WARC-Refers-To: {_clean(values['refers_to'] or '')}", f"WARC-Profile: {PROFILE}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def member(content: bytes, level: int = 4) -> bytes:
    """A gzip member whose extra field "sl" holds its own length and that of its content."""
    packer = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = packer.compress(content) + packer.flush()
    size = 10 + 2 + 12 + len(body) + 8
    known = (size, len(content)) if max(size, len(content)) < 1 << 32 else (0, 0)
    head = b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H2sHII", 12, b"sl", 8, *known)
    return head + body + struct.pack("<II", zlib.crc32(content), len(content) & 0xFFFFFFFF)


@dataclass
class Written(WriterCommitMessage):
    files: list


class WarcWriter(DataSourceArrowWriter):
    """Each task writes its own files; the driver names the committed ones in a manifest.

    Files of failed or repeated attempts carry another name and are not in the manifest.
    """

    def __init__(self, options: dict, overwrite: bool):
        self.path, self.date = options["path"], options.get("date", "1970-01-01T00:00:00Z")
        self.file_bytes = int(options.get("file_bytes", FILE_BYTES))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        system, folder = place(self.path)
        system.create_dir(folder, recursive=True)
        task = TaskContext.get()
        files, out = [], None
        for batch in iterator:
            names = batch.schema.names
            for row in range(batch.num_rows):
                if out is None or out.tell() >= self.file_bytes:
                    if out is not None:
                        out.close()
                    name = f"part-{task.partitionId():05d}-{task.taskAttemptId()}-{len(files)}.warc.gz"
                    out = system.open_output_stream(f"{folder}/{name}", compression=None)
                    files.append(name)
                out.write(member(record({n: batch.column(i)[row].as_py() for i, n in enumerate(names)}, self.date)))
        if out is not None:
            out.close()
        return Written(files)

    def commit(self, messages: list) -> None:
        system, folder = place(self.path)
        system.create_dir(folder, recursive=True)
        files = sorted(name for message in messages if message for name in message.files)
        with system.open_output_stream(f"{folder}/{MANIFEST}", compression=None) as out:
            out.write(json.dumps({"files": files}).encode())

    def abort(self, messages: list) -> None:
        system, folder = place(self.path)
        for message in messages:
            for name in message.files if message else []:
                system.delete_file(f"{folder}/{name}")


# Reading


def header_fields(lines: bytes) -> dict[str, str]:
    """Fields of a header block by lower-cased name; the first of a name counts."""
    fields: dict[str, str] = {}
    for line in lines.split(b"\r\n")[1:]:
        name, colon, value = line.decode("utf-8", "replace").partition(":")
        if colon:
            fields.setdefault(name.strip().lower(), value.strip())
    return fields


class _Member:
    """Content of one gzip member, unpacked as far as it is asked for."""

    def __init__(self, file, start: int):
        self.file, self.at = file, start
        self.unpacker, self.content = zlib.decompressobj(-15), b""

    def upto(self, size: int) -> bytes:
        while len(self.content) < size and not self.unpacker.eof:
            self.file.seek(self.at)
            packed = self.file.read(max(HEAD, min(size - len(self.content), 1 << 20)))
            if not packed:
                break
            self.at += len(packed)
            self.content += self.unpacker.decompress(packed)
        return self.content

    def through(self, mark: bytes, start: int = 0, most: int | None = None) -> int:
        """End of the first ``mark``, or -1."""
        size = start + HEAD // 4
        while True:
            content = self.upto(size if most is None else min(size, most))
            found = content.find(mark, start)
            if found >= 0:
                return found + len(mark)
            if self.unpacker.eof or len(content) < size or (most is not None and size >= most):
                return -1
            size *= 2


def _skip_lengths(file, at: int) -> tuple[int, int] | None:
    """(start of the packed content, length of the member) of a member that has the "sl" field."""
    file.seek(at)
    head = file.read(24)
    if len(head) < 24 or head[:4] != b"\x1f\x8b\x08\x04":
        return None
    extra, name, size, length, _ = struct.unpack("<H2sHII", head[10:])
    return (at + 12 + extra, length) if name == b"sl" and size == 8 and length else None


def _indexed(file, size: int, wanted: Callable[[dict], bool], payloads: bool):
    at = 0
    while at < size:
        found = _skip_lengths(file, at)
        if found is None:  # not ours: read on as a stream from here
            file.seek(at)
            yield from _streamed(gzip.GzipFile(fileobj=file), wanted, payloads, at)
            return
        content = _Member(file, found[0])
        end = content.through(b"\r\n\r\n")
        fields = header_fields(content.content[:end]) if end > 0 else {}
        if fields and wanted(fields):
            length = int(fields.get("content-length", 0))
            if payloads or not _is_http(fields):
                block = content.upto(end + length)[end: end + length]
            else:
                stop = content.through(b"\r\n\r\n", end, end + length)
                block = content.content[end: stop if stop > 0 else end]
            yield at, fields, block
        at += found[1]


def _streamed(stream, wanted: Callable[[dict], bool], payloads: bool, base: int = 0):
    """Records one after the other; unwanted blocks are passed over, by seeking where the file allows it."""
    while True:
        at = base if isinstance(stream, gzip.GzipFile) else stream.tell()
        line = stream.readline()
        while line in (b"\r\n", b"\n"):
            line = stream.readline()
        if not line:
            return
        lines = [line]
        while line not in (b"\r\n", b"\n", b""):
            line = stream.readline()
            lines.append(line)
        fields = header_fields(b"".join(lines))
        length = int(fields.get("content-length", 0))
        if wanted(fields):
            block = stream.read(length)
            yield at, fields, block if payloads or not _is_http(fields) else block[: block.find(b"\r\n\r\n") + 4]
        else:
            stream.seek(length, io.SEEK_CUR)


def _is_http(fields: dict[str, str]) -> bool:
    return fields.get("content-type", "").startswith("application/http")


def _row(file: str, at: int, fields: dict[str, str], block: bytes, payloads: bool) -> dict:
    body, size = block, len(block)
    if _is_http(fields):
        end = block.find(b"\r\n\r\n") + 4
        inner = header_fields(block[:end])
        body = block[end:]
        size = int(inner["content-length"]) if inner.get("content-length", "").isdigit() else max(0, int(fields.get("content-length", 0)) - end)
    row = {name: fields.get(header) for name, header in HEADERS.items()}
    row["content_length"] = int(row["content_length"] or 0)
    holds = payloads and fields.get("warc-type") != "revisit"
    return row | {"headers": list(fields.items()), "payload_bytes": size, "payload": body if holds else None, "file": file, "offset": at}


@dataclass
class WarcFile(InputPartition):
    path: str
    size: int


class WarcReader(DataSourceReader):
    """One partition per archive; predicates on header columns are decided before a block is unpacked."""

    def __init__(self, options: dict):
        self.path = options["path"]
        self.payloads = str(options.get("payload", "true")).lower() != "false"
        self.filters: list[Filter] = []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for each in filters:
            if len(each.attribute) == 1 and each.attribute[0] in HEADERS and type(each) in _TESTS:
                self.filters.append(each)
            else:
                yield each

    def partitions(self) -> list[WarcFile]:
        """Archives named by the manifest, or all of the folder where there is none (or the one file)."""
        system, folder = place(self.path)
        info = system.get_file_info(folder)
        if info.type == fs.FileType.File:
            return [WarcFile(folder, info.size)]
        listed = {x.base_name: x for x in system.get_file_info(fs.FileSelector(folder)) if x.type == fs.FileType.File}
        if MANIFEST in listed:
            with system.open_input_stream(f"{folder}/{MANIFEST}") as source:
                names = json.loads(source.read())["files"]
        else:
            names = sorted(name for name in listed if name.endswith((".warc", ".warc.gz")))
        return [WarcFile(f"{folder}/{name}", listed[name].size) for name in names]

    def _wanted(self, fields: dict[str, str]) -> bool:
        for each in self.filters:
            name = each.attribute[0]
            value = fields.get(HEADERS[name])
            if name == "content_length":
                value = int(value or 0)
            if not _TESTS[type(each)](value, getattr(each, "value", None)):
                return False
        return True

    def read(self, partition: WarcFile) -> Iterator[pa.RecordBatch]:
        if partition is None:
            return
        system, _ = place(self.path)
        kind = _arrow_schema()
        rows, size = [], 0
        with system.open_input_file(partition.path) as native, io.BufferedReader(native, 1 << 16) as file:
            packed = file.read(2) == b"\x1f\x8b"
            file.seek(0)
            found = _indexed(file, partition.size, self._wanted, self.payloads) if packed else _streamed(file, self._wanted, self.payloads)
            for at, fields, block in found:
                rows.append(_row(partition.path, at, fields, block, self.payloads))
                size += len(block) + 500
                if size > BATCH_BYTES:
                    yield pa.RecordBatch.from_pylist(rows, kind)
                    rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, kind)


_TESTS = {
    EqualTo: lambda value, asked: value is not None and value == asked,
    In: lambda value, asked: value is not None and value in asked,
    IsNotNull: lambda value, asked: value is not None,
    IsNull: lambda value, asked: value is None,
    StringStartsWith: lambda value, asked: value is not None and value.startswith(asked),
    StringEndsWith: lambda value, asked: value is not None and value.endswith(asked),
    StringContains: lambda value, asked: value is not None and asked in value,
    GreaterThan: lambda value, asked: value is not None and value > asked,
    GreaterThanOrEqual: lambda value, asked: value is not None and value >= asked,
    LessThan: lambda value, asked: value is not None and value < asked,
    LessThanOrEqual: lambda value, asked: value is not None and value <= asked,
}


def _arrow_schema() -> pa.Schema:
    text = pa.string()
    return pa.schema([
        *((name, pa.int64() if name == "content_length" else text) for name in HEADERS), ("headers", pa.map_(text, text)),
        ("payload_bytes", pa.int64()), ("payload", pa.binary()), ("file", text), ("offset", pa.int64()),
    ])


class WarcSource(DataSource):
    """format("warc") with options path, payload (false: headers only), date, file_bytes."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(dict(self.options))

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(dict(self.options), overwrite)


def use_warc(spark: SparkSession) -> None:
    """Register the source and let predicates reach it."""
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def write_warc(records: DataFrame, path: str, **options) -> None:
    """Write records (record_id, record_type, target_uri, refers_to, payload) as packed archives.

    ``path`` must be new, on storage that all executors and the driver share.
    """
    use_warc(records.sparkSession)
    chosen = records.select("record_id", "record_type", "target_uri", "refers_to", "payload")
    chosen.write.format("warc").mode("append").options(path=path, **options).save()


def read_warc(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """Records of an archive or a folder of archives; filters on header columns are pushed down.

    A gzip archive whose members carry their length is passed over member by member: of an
    unwanted record only the first kilobytes are unpacked. Other archives are read in order.
    """
    use_warc(spark)
    return spark.read.format("warc").options(path=path, payload=str(payload).lower()).load()


def record_name(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:x-page:"), F.coalesce(page_id.cast("string"), F.lit("none")), F.lit(">"))


def page_of(name: Column) -> Column:
    return F.regexp_extract(name, r"^<urn:x-page:(-?\d+)>$", 1).try_cast("long")


def page_records(pages: DataFrame, least: int = 0) -> DataFrame:
    """Pages as records: of equal payloads of at least ``least`` bytes, the largest page_id is the
    response and the others revisit it.

    Payloads are the UTF-8 bytes of html, null as empty. Pages without an id revisit a page
    with one; where no page of a group has an id, or several rows repeat the largest, each
    of those is a response.
    """
    payload = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").alias("target_uri"), payload.alias("payload")).withColumn(
        "same", F.when(F.octet_length("payload") >= least, F.sha2("payload", 256))
    )
    groups = rows.where("same IS NOT NULL").groupBy("same").agg(F.max("page_id").alias("first"))
    joined = rows.join(groups, "same", "left")
    revisits = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return joined.select(
        record_name(F.col("page_id")).alias("record_id"), F.when(revisits, "revisit").otherwise("response").alias("record_type"),
        "target_uri", F.when(revisits, record_name(F.col("first"))).alias("refers_to"), "payload",
    )


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of archived pages.

    Responses are read with their payload, whose digest is made again and must be the one
    in the header; of revisits only the headers are read.
    """
    full = read_warc(spark, path).where(F.col("record_type") == "response")
    again = F.concat(F.lit("sha1:"), base32(F.unhex(F.sha1("payload"))))
    checked = F.when(again == F.col("payload_digest"), again).otherwise(
        F.raise_error(F.concat(F.lit("payload does not match its digest: "), F.col("record_id")))
    )
    responses = full.select("record_id", F.octet_length("payload").cast("long").alias("payload_bytes"), checked.alias("digest"), "record_type", "refers_to")
    revisits = read_warc(spark, path, payload=False).where(F.col("record_type") == "revisit").select(
        "record_id", "payload_bytes", F.col("payload_digest").alias("digest"), "record_type", "refers_to"
    )
    return responses.unionByName(revisits).select(
        page_of(F.col("record_id")).alias("page_id"), "payload_bytes", F.substring_index("digest", ":", -1).alias("payload_digest"),
        "record_type", page_of(F.col("refers_to")).alias("refers_to"),
    )


def base32(content: Column) -> Column:
    """Base32 text of 20 bytes."""
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    digits = []
    for group in range(4):
        number = F.conv(F.hex(F.substring(content, group * 5 + 1, 5)), 16, 10).cast("long")
        digits += [F.substring(F.lit(letters), (F.shiftright(number, 35 - 5 * i).bitwiseAND(F.lit(31)) + 1).cast("int"), F.lit(1)) for i in range(8)]
    return F.concat(*digits)
