"""Landed response pages as a Python data source: the months asked for decide which files are opened.

A page is a JSON file at ``month/start_end-….json``, so a plan needs names only. Pages of
months not asked for stay shut; pages whose status is not asked for are read but not handed
on. Both are options of a read and not pushed-down filters, which Spark keeps with the
source and not with the scan: two uses of one frame with different filters would both see
the last ones. A page that is no page (cut short, not JSON, without the
envelope) is a row with a status of its own and not an error, so one bad file never stops a
load. Writing names the committed files in a manifest, so files of lost tasks don't count.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

from tapflow import fixed
from tapflow.schemas import HOURLY_WIDE

SCHEMA = "month string, start_row long, end_row long, page_file string, code string, message string, total long, n_records long, records string"
PAGE = "month string, start_row long, end_row long, content string"
MANIFEST = "_pages.json"
UNREADABLE = "UNREADABLE"
# Bytes of pages that one task reads; a larger page is a task of its own.
TASK_BYTES = 32 << 20
NAME = r"(?:^|/)([^/]+)/(\d+)_(\d+)(?:-[^/]*)?\.json$"


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a URI or a plain path."""
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


@dataclass
class Pages(InputPartition):
    files: list[tuple[str, str, int, int]]


def page_row(content: bytes, envelope: str, wanted: Callable[[str], bool]) -> tuple | None:
    """code, message, total, number of records and their JSON text; None if the status is not wanted."""
    try:
        body = json.loads(content)[envelope]
        result = body.get("RESULT") or {}
        code, message = result.get("CODE") or fixed.PAGE_UNKNOWN, result.get("MESSAGE") or "no message"
        total, rows = int(body.get("list_total_count") or 0), body.get("row") or []
        found = (code, message, total, len(rows), json.dumps(rows, ensure_ascii=False))
    except (ValueError, TypeError, KeyError, AttributeError) as error:
        found = (UNREADABLE, f"{type(error).__name__}: {error}"[:200], 0, 0, "[]")
    return found if wanted(found[0]) else None


class LandedReader(DataSourceReader):
    """Plans tasks of neighbouring pages from names and sizes."""

    def __init__(self, options: dict):
        self.path, self.envelope = options["path"], options.get("envelope", fixed.PAGE_ENVELOPE)
        self.task_bytes = int(options.get("task_bytes", TASK_BYTES))
        self.first, self.last = options.get("first_month", ""), options.get("last_month", "\U0010ffff")
        self.codes = json.loads(options.get("codes", "null"))

    def _asked(self, code: str) -> bool:
        return self.codes is None or code in self.codes

    def _listed(self) -> Iterator[tuple[str, int]]:
        system, folder = file_system(self.path)
        if system.get_file_info(f"{folder}/{MANIFEST}").type == fs.FileType.File:
            with system.open_input_stream(f"{folder}/{MANIFEST}") as source:
                yield from map(tuple, json.loads(source.read()))
            return
        for info in system.get_file_info(fs.FileSelector(folder, recursive=True)):
            if info.type == fs.FileType.File:
                yield info.path[len(folder):].lstrip("/"), info.size

    def partitions(self) -> list[Pages]:
        named = ((re.search(NAME, name), name, size) for name, size in self._listed())
        chosen = sorted((found[1], int(found[2]), int(found[3]), name, size) for found, name, size in named if found and self.first <= found[1] <= self.last)
        tasks, size = [], self.task_bytes
        for month, start, end, name, own in chosen:
            if size + own > self.task_bytes:
                tasks.append(Pages([]))
                size = 0
            tasks[-1].files.append((name, month, start, end))
            size += own
        return tasks or [Pages([])]

    def read(self, partition: Pages) -> Iterator[pa.RecordBatch]:
        system, folder = file_system(self.path)
        for name, month, start, end in partition.files:
            with system.open_input_stream(f"{folder}/{name}") as source:
                found = page_row(source.read(), self.envelope, self._asked)
            if found is not None:
                values = (month, start, end, name, *found)
                yield pa.RecordBatch.from_arrays([pa.array([x]) for x in values], [x.split()[0] for x in SCHEMA.split(", ")])


@dataclass
class Landed(WriterCommitMessage):
    files: list[tuple[str, int]]


class LandedWriter(DataSourceWriter):
    """A file per row; the manifest names what committed tasks wrote."""

    def __init__(self, options: dict):
        self.path = options["path"]

    def write(self, iterator) -> Landed:
        system, folder = file_system(self.path)
        files, known = [], set()
        for row in iterator:
            if row["month"] not in known:
                system.create_dir(f"{folder}/{row['month']}", recursive=True)
                known.add(row["month"])
            content = (row["content"] or "").encode()
            name = f"{row['month']}/{row['start_row']}_{row['end_row']}-{TaskContext.get().taskAttemptId()}.json"
            with system.open_output_stream(f"{folder}/{name}", compression=None) as out:
                out.write(content)
            files.append((name, len(content)))
        return Landed(files)

    def commit(self, messages: list) -> None:
        system, folder = file_system(self.path)
        system.create_dir(folder, recursive=True)
        with system.open_output_stream(f"{folder}/{MANIFEST}", compression=None) as out:
            out.write(json.dumps(sorted(x for message in messages if message for x in message.files)).encode())

    def abort(self, messages: list) -> None:
        system, folder = file_system(self.path)
        for message in messages:
            for name, _ in message.files if message else []:
                system.delete_file(f"{folder}/{name}")


class LandedSource(DataSource):
    """format("landed_pages") with options path, envelope, first_month, last_month, codes, task_bytes."""

    @classmethod
    def name(cls) -> str:
        return "landed_pages"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> LandedReader:
        return LandedReader(dict(self.options))

    def writer(self, schema, overwrite: bool) -> LandedWriter:
        return LandedWriter(dict(self.options))


def land_pages(pages: DataFrame, path: str) -> None:
    """Write pages (month, start_row, end_row, content) as files under a new ``path`` that all
    executors and the driver share."""
    pages.sparkSession.dataSource.register(LandedSource)
    chosen = pages.select("month", F.col("start_row").cast("long"), F.col("end_row").cast("long"), "content")
    chosen.write.format("landed_pages").mode("append").options(path=path).save()


def read_landed(
    spark: SparkSession, path: str, first_month: str | None = None, last_month: str | None = None, codes: list[str] | None = None,
    envelope: str = fixed.PAGE_ENVELOPE, task_bytes: int = TASK_BYTES,
) -> DataFrame:
    """One row per landed page: month, rows asked for, file, status, promised total, records as JSON.

    Months from ``first_month`` to ``last_month`` (both included) and pages with one of
    ``codes`` are read; files of other months are not opened.
    """
    spark.dataSource.register(LandedSource)
    asked = {"first_month": first_month, "last_month": last_month, "codes": None if codes is None else json.dumps(codes)}
    options = {name: value for name, value in asked.items() if value is not None}
    return spark.read.format("landed_pages").options(path=path, envelope=envelope, task_bytes=task_bytes, **options).load()


def landed_records(pages: DataFrame, row: T.StructType | str = HOURLY_WIDE) -> DataFrame:
    """One row per record of good pages, with the page's month; a bad page gives none."""
    kind = T.StructType.fromDDL(row) if isinstance(row, str) else row
    good = pages.where(F.col("code") == fixed.PAGE_OK)
    return good.select("month", F.inline(F.from_json("records", T.ArrayType(kind))))
