"""Workbooks as a Spark data source: a partition per sheet, columns chosen in the reader, rejects as a second table.

``spark.read.format("workbook")`` reads a folder or file; ``frame.write.format("workbook")`` writes one. Options:

* ``columns``: a JSON list of headers. Cells under other headers are never decoded.
* ``files``, ``sheets``: JSON lists of file names and sheet names; others get no partition.
* ``table``: ``cells`` (default) or ``rejects``, the files and sheets that could not be read.
* ``max_mb``: larger files are rejects.
* ``group_mb``: sheets are put together in one partition up to this size, for folders of many small books; 0 keeps them apart.

Files are opened where their sheets are read, at the members that are needed. The path may be in any store that Arrow opens;
for others ``notewright.sources.workbook.read_cells`` has Spark fetch the files.
"""

from __future__ import annotations

import json
import re
import uuid
import zipfile
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from itertools import groupby
from xml.etree import ElementTree
from xml.sax.saxutils import escape, quoteattr

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceWriter,
    InputPartition,
    WriterCommitMessage,
)

from notewright.sources.workbook import date_styles, sheet_parts, sheet_rows, shared_text

NAME = "workbook"
CELLS = (
    "file_path string, file_name string, sheet_index int, sheet string, row_index int, "
    "cells array<struct<col:int,header:string,numeric:boolean,value:string>>"
)
REJECTS = "file_path string, file_name string, sheet string, reason string"
_CHOICES = {"files": "file_name", "sheets": "sheet"}
_BATCH_ROWS = 5000
_OPENED_AT_ONCE = 32
_BOOK = re.compile(r"(?i)(?![~._]).*\.xls[xmb]?")
_CELL = pa.struct([("col", pa.int32()), ("header", pa.string()), ("numeric", pa.bool_()), ("value", pa.string())])
_ARROW = {
    "cells": pa.schema(
        [
            ("file_path", pa.string()),
            ("file_name", pa.string()),
            ("sheet_index", pa.int32()),
            ("sheet", pa.string()),
            ("row_index", pa.int32()),
            ("cells", pa.list_(_CELL)),
        ]
    ),
    "rejects": pa.schema([(name, pa.string()) for name in ("file_path", "file_name", "sheet", "reason")]),
}

# Names of the file format's parts and their XML name spaces.
_MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_OFFICE = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_PACKAGE = "http://schemas.openxmlformats.org/package/2006"


def located(path: str) -> tuple[fs.FileSystem, str]:
    """The store of a path and the path in it; ``file:/x`` and plain paths are local."""
    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "/", path))


@dataclass(frozen=True)
class Sheet:
    path: str
    index: int | None
    name: str | None
    member: str | None
    size: int
    reason: str | None = None

    @property
    def file_name(self) -> str:
        return self.path.rpartition("/")[2]


class SheetGroup(InputPartition):
    def __init__(self, sheets: list[Sheet]):
        super().__init__(sheets[0].path)
        self.sheets = sheets


class WorkbookReader(DataSourceReader):
    """Plans a partition per sheet and decodes it; sheets that are not asked for are never opened."""

    def __init__(self, options: dict[str, str]):
        self.root = options["path"]
        self.table = options.get("table", "cells")
        if self.table not in _ARROW:
            raise ValueError(f"no such table: {self.table}")
        self.columns = frozenset(json.loads(options["columns"])) if "columns" in options else None
        self.max_bytes = float(options.get("max_mb", "inf")) * 1024 * 1024
        self.group_bytes = float(options.get("group_mb", "0")) * 1024 * 1024
        self.chosen = {name: set(json.loads(options[key])) for key, name in _CHOICES.items() if key in options}

    def _wanted(self, sheet: Sheet) -> bool:
        named = {"file_name": sheet.file_name, "sheet": sheet.name}
        return all(named[name] in values for name, values in self.chosen.items())

    def _sheets_of(self, store: fs.FileSystem, info: fs.FileInfo) -> list[Sheet]:
        if info.size > self.max_bytes:
            limit = f"{self.max_bytes / 1024 / 1024:g}"
            return [Sheet(info.path, None, None, None, 0, f"File too large: {info.size / 1024 / 1024:.1f}MB > {limit}MB")]
        try:
            with store.open_input_file(info.path) as stream, zipfile.ZipFile(stream) as book:
                parts = sheet_parts(book)
                sizes = {member.filename: member.file_size for member in book.infolist()}
        except Exception as problem:
            return [Sheet(info.path, None, None, None, 0, f"File could not be opened: {problem}")]
        if not parts:
            return [Sheet(info.path, None, None, None, 0, "No sheets found in file")]
        return [Sheet(info.path, i, name, member, sizes.get(member, 0)) for i, (name, member) in enumerate(parts)]

    def partitions(self) -> list[InputPartition]:
        """Reads the directories of the files only, several at a time."""
        store, root = located(self.root)
        info = store.get_file_info(root)
        found = [info] if info.is_file else store.get_file_info(fs.FileSelector(root))
        books = sorted((x for x in found if x.is_file and _BOOK.fullmatch(x.base_name)), key=lambda x: x.path)
        books = [x for x in books if "file_name" not in self.chosen or x.base_name in self.chosen["file_name"]]
        with ThreadPoolExecutor(_OPENED_AT_ONCE) as pool:
            sheets = [s for of in pool.map(lambda x: self._sheets_of(store, x), books) for s in of]
        groups: list[list[Sheet]] = []
        held = 0
        for sheet in sheets:
            if sheet.reason is not None and self.table == "cells" or not self._wanted(sheet):
                continue
            if not groups or held + sheet.size > self.group_bytes:
                groups.append([])
                held = 0
            groups[-1].append(sheet)
            held += sheet.size
        return [SheetGroup(group) for group in groups] or [InputPartition(None)]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        store = located(self.root)[0]
        kind = _ARROW[self.table]

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            columns = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, kind, strict=True)], schema=kind)

        rows: list[tuple] = []
        for sheet in getattr(partition, "sheets", []):
            for row in self._rows(store, sheet):
                rows.append(row)
                if len(rows) == _BATCH_ROWS:
                    yield batch(rows)
                    rows = []
        if rows:
            yield batch(rows)

    def _rows(self, store: fs.FileSystem, sheet: Sheet) -> Iterator[tuple]:
        """A sheet's rows, or none where it breaks off anywhere: it is read through before a row is given out."""
        if sheet.reason is not None:
            yield sheet.path, sheet.file_name, None, sheet.reason
            return
        try:
            with store.open_input_file(sheet.path) as stream, zipfile.ZipFile(stream) as book:
                shared = []
                if "xl/sharedStrings.xml" in book.namelist():
                    shared = [shared_text(item) for item in ElementTree.fromstring(book.read("xl/sharedStrings.xml"))]
                dates = date_styles(book)
                for _ in sheet_rows(book, sheet.member, shared, dates, self.columns):
                    pass
                if self.table == "cells":
                    for row_index, cells in sheet_rows(book, sheet.member, shared, dates, self.columns):
                        yield sheet.path, sheet.file_name, sheet.index, sheet.name, row_index, cells
        except (zipfile.BadZipFile, ElementTree.ParseError, KeyError, ValueError, IndexError) as problem:
            if self.table == "rejects":
                yield sheet.path, sheet.file_name, sheet.name, f"Sheet could not be read: {problem}"


@dataclass
class Written(WriterCommitMessage):
    """Books of one task, under the names they have until the job is done."""

    names: list[tuple[str, str]]


def _reference(column: int, row: int) -> str:
    name = ""
    column += 1
    while column:
        column, rest = divmod(column - 1, 26)
        name = chr(65 + rest) + name
    return f'r="{name}{row}"'


class _Book:
    """One workbook being written, sheet by sheet; texts go to the table of shared strings."""

    def __init__(self, stream) -> None:
        self.book = zipfile.ZipFile(stream, "w", zipfile.ZIP_DEFLATED)
        self.shared: dict[str, int] = {}
        self.sheets: list[str] = []

    def _cell(self, column: int, row: int, value: str | None, numeric: bool) -> str:
        if value is None:
            return ""
        if numeric:
            return f"<c {_reference(column, row)}><v>{escape(value)}</v></c>"
        return f'<c {_reference(column, row)} t="s"><v>{self.shared.setdefault(value, len(self.shared))}</v></c>'

    def add(self, name: str, rows: Iterator[Row]) -> None:
        self.sheets.append(name)
        with self.book.open(f"xl/worksheets/sheet{len(self.sheets)}.xml", "w") as out:
            out.write(f'<worksheet xmlns="{_MAIN}"><sheetData>'.encode())
            for at, row in enumerate(rows):
                if not at:  # a placeholder stands for a blank header
                    named = [None if c.header == f"Unnamed: {c.col}" else c.header for c in row.cells]
                    cells = (self._cell(c.col, 1, text, False) for c, text in zip(row.cells, named, strict=True))
                    out.write(f'<row r="1">{"".join(cells)}</row>'.encode())
                number = row.row_index + 2
                cells = (self._cell(c.col, number, c.value, c.numeric) for c in row.cells)
                out.write(f'<row r="{number}">{"".join(cells)}</row>'.encode())
            out.write(b"</sheetData></worksheet>")

    def close(self) -> None:
        names = "".join(f'<sheet name={quoteattr(n)} sheetId="{i}" r:id="rId{i}"/>' for i, n in enumerate(self.sheets, 1))
        links = "".join(
            f'<Relationship Id="rId{i}" Type="{_OFFICE}/worksheet" Target="worksheets/sheet{i}.xml"/>'
            for i in range(1, len(self.sheets) + 1)
        )
        items = "".join(f'<si><t xml:space="preserve">{escape(text)}</t></si>' for text in self.shared)
        kinds = "".join(
            f'<Override PartName="/xl/{part}.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.{kind}+xml"/>'
            for part, kind in [
                ("workbook", "sheet.main"),
                ("sharedStrings", "sharedStrings"),
                *((f"worksheets/sheet{i}", "worksheet") for i in range(1, len(self.sheets) + 1)),
            ]
        )
        rels = "application/vnd.openxmlformats-package.relationships+xml"
        parts = {
            "xl/workbook.xml": f'<workbook xmlns="{_MAIN}" xmlns:r="{_OFFICE}"><sheets>{names}</sheets></workbook>',
            "xl/_rels/workbook.xml.rels": f'<Relationships xmlns="{_PACKAGE}/relationships">{links}</Relationships>',
            "xl/sharedStrings.xml": f'<sst xmlns="{_MAIN}">{items}</sst>',
            "_rels/.rels": f'<Relationships xmlns="{_PACKAGE}/relationships"><Relationship Id="rId1" '
            f'Type="{_OFFICE}/officeDocument" Target="xl/workbook.xml"/></Relationships>',
            "[Content_Types].xml": f'<Types xmlns="{_PACKAGE}/content-types"><Default Extension="rels" ContentType="{rels}"/>'
            f'<Default Extension="xml" ContentType="application/xml"/>{kinds}</Types>',
        }
        for name, content in parts.items():
            self.book.writestr(name, content)
        self.book.close()


class WorkbookWriter(DataSourceWriter):
    """Writes sorted rows as books. They get their names when the whole job is done, so that tasks may run again."""

    def __init__(self, options: dict[str, str]):
        self.root = options["path"]

    def write(self, iterator: Iterator[Row]) -> WriterCommitMessage:
        store, root = located(self.root)
        store.create_dir(root, recursive=True)
        names = []
        for file_name, rows in groupby(iterator, key=lambda row: row.file_name):
            held = f"{root}/_{uuid.uuid4().hex}"
            with store.open_output_stream(held) as stream:
                book = _Book(stream)
                for sheet, own in groupby(rows, key=lambda row: row.sheet):
                    book.add(sheet, own)
                book.close()
            names.append((held, f"{root}/{file_name}"))
        return Written(names)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        store = located(self.root)[0]
        for message in messages:
            for held, name in message.names if message else []:
                store.move(held, name)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        store = located(self.root)[0]
        for message in messages:
            for held, _ in message.names if message else []:
                store.delete_file(held)


class WorkbookFormat(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return REJECTS if self.options.get("table") == "rejects" else CELLS

    def reader(self, schema) -> DataSourceReader:
        return WorkbookReader(dict(self.options))

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return WorkbookWriter(dict(self.options))


def read_sheets(spark: SparkSession, path: str, columns: Sequence[str] | None = None, **options: str) -> DataFrame:
    """Rows of every readable sheet below ``path`` in the shape of ``read_cells``, decoded sheet by sheet.

    With ``columns`` only these headers' cells are decoded and kept, in sheet order; a sheet that lacks one keeps those it has.
    """
    spark.dataSource.register(WorkbookFormat)
    chosen = {} if columns is None else {"columns": json.dumps(list(columns))}
    return spark.read.format(NAME).options(**chosen, **options).load(path)


def rejected_sheets(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """``(file_path, file_name, sheet, reason)`` of the files and sheets that ``read_sheets`` leaves out."""
    return read_sheets(spark, path, table="rejects", **options)


def write_workbooks(rows: DataFrame, path: str) -> None:
    """Write rows (file_name, sheet_index, sheet, row_index, cells) as workbooks below ``path``.

    A book is written by one task, which a sheet's 1,048,576 rows bound; equal places keep no order. All rows of a sheet
    must list the same headers, and a header ``Unnamed: k`` at column ``k`` is left blank.
    """
    rows.sparkSession.dataSource.register(WorkbookFormat)
    ordered = rows.select("file_name", "sheet_index", "sheet", "row_index", "cells").repartition("file_name")
    ordered = ordered.sortWithinPartitions("file_name", "sheet_index", "row_index")
    ordered.write.format(NAME).mode("append").save(path)
