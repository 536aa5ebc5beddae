"""Workbooks (zip + XML) as rows of cells.

Spark lists, admits and distributes the files; inside a task a file is decoded
with the standard library. A file is one unit of work, bounded by the admission
size, and rows leave the decoder already assembled, so no shuffle follows.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Container, Iterator, Sequence
from datetime import datetime, timedelta
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from notewright.functions.text import file_name
from notewright.sources.files import WORKBOOK_FILES, admit_by_size, list_files

HEADER_ROW = -1
MAX_MB = None  # no bound; an admission limit is the caller's choice

CELL_ROWS = (
    "file_path string, file_name string, sheet_index int, sheet string, row_index int, "
    "cells array<struct<col:int,header:string,numeric:boolean,value:string>>, error string"
)

# Texts that count as a missing cell.
MISSING = (
    "", "#N/A", "#N/A N/A", "#NA", "#NULL!", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Built-in number formats that show a date or a time.
_DATE_FORMATS = frozenset([*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)])

_RELATION = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
_BATCH_ROWS = 5000


def _name(element) -> str:
    return element.tag.rpartition("}")[2]


def _column(reference: str) -> int:
    number = 0
    for letter in reference:
        if not letter.isalpha():
            break
        number = number * 26 + ord(letter.upper()) - 64
    return number - 1


def shared_text(element) -> str:
    """Text of a string item, without phonetic hints."""
    if _name(element) == "rPh":
        return ""
    own = (element.text or "") if _name(element) == "t" else ""
    return own + "".join(shared_text(child) for child in element)


def date_styles(book: zipfile.ZipFile) -> list[bool]:
    if "xl/styles.xml" not in book.namelist():
        return []
    root = ElementTree.fromstring(book.read("xl/styles.xml"))
    custom = {}
    for node in root.iter():
        if _name(node) == "numFmt":
            code = re.sub(r'"[^"]*"|\[[^\]]*\]|\\.', "", node.get("formatCode", ""))
            custom[int(node.get("numFmtId"))] = re.search(r"[dmyhs]", code, re.I) is not None
    for node in root:
        if _name(node) == "cellXfs":
            ids = [int(style.get("numFmtId", 0)) for style in node]
            return [custom.get(i, i in _DATE_FORMATS) for i in ids]
    return []


def _moment(serial: float) -> str:
    moment = datetime(1899, 12, 30) + timedelta(milliseconds=round(serial * 86_400_000))
    return str(moment.time() if 0 <= serial < 1 else moment)


def _value(cell, shared: list[str], dates: list[bool]) -> tuple[str | None, bool]:
    """Text of a cell and whether it is a number; integral numbers print without a fraction."""
    kind = cell.get("t", "n")
    if kind == "inlineStr":
        return "".join(shared_text(part) for part in cell if _name(part) == "is"), False
    raw = next((part.text for part in cell if _name(part) == "v"), None)
    if raw is None or kind == "e":
        return None, False
    if kind == "s":
        return shared[int(raw)], False
    if kind == "b":
        return str(raw == "1"), False
    if kind != "n":
        return raw, False
    number, style = float(raw), int(cell.get("s", 0))
    if style < len(dates) and dates[style]:
        return _moment(number), False
    return (str(int(number)) if number == int(number) else repr(number)), True


def _headers(cells: dict[int, tuple[str | None, bool]], width: int) -> list[tuple[str, bool]]:
    """Header names: blanks get a placeholder, repeats a numbered suffix."""
    seen: dict[str, int] = {}
    names = []
    for at in range(width):
        text, numeric = cells.get(at, (None, False))
        name = f"Unnamed: {at}" if text is None or text == "" else text
        repeat = seen.get(name, 0)
        seen[name] = repeat + 1
        names.append((f"{name}.{repeat}" if repeat else name, numeric and not repeat))
    return names


def sheet_parts(book: zipfile.ZipFile) -> list[tuple[str, str]]:
    targets = {
        link.get("Id"): link.get("Target") for link in ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))
    }
    found = []
    for node in ElementTree.fromstring(book.read("xl/workbook.xml")).iter():
        if _name(node) == "sheet":
            target = targets[node.get(_RELATION)]
            found.append((node.get("name"), target.lstrip("/") if target.startswith("/") else f"xl/{target}"))
    return found


def sheet_rows(
    book: zipfile.ZipFile, part: str, shared: list[str], dates: list[bool], wanted: Container[str] | None = None
) -> Iterator[tuple]:
    """``(row_index, cells)`` of one sheet; the header row comes last, when the full width is known.

    With ``wanted`` only cells under these headers are decoded and returned.
    """
    header: dict[int, tuple] = {}
    names: list[tuple] = []
    width, last = 0, -1
    with book.open(part) as stream:
        for _, node in ElementTree.iterparse(stream):
            if _name(node) != "row":
                continue
            last = int(node.get("r", last + 2)) - 1
            cells, at = {}, -1
            for cell in node:
                reference = cell.get("r")
                at = _column(reference) if reference else at + 1
                if wanted is not None and last and (names[at][0] if at < len(names) else f"Unnamed: {at}") not in wanted:
                    continue
                text, numeric = _value(cell, shared, dates)
                if text is not None:
                    cells[at] = (text, numeric)
            node.clear()
            width = max(width, max(cells, default=-1) + 1)
            if last == 0:
                header = cells
                names = _headers(header, width)
            else:
                if len(names) < width:
                    names = _headers(header, width)
                yield (
                    last - 1,
                    [
                        {"col": i, "header": name, "numeric": numeric, "value": cells.get(i, (None,))[0]}
                        for i, (name, numeric) in enumerate(names)
                        if wanted is None or name in wanted
                    ],
                )
    yield (
        HEADER_ROW,
        [
            {"col": i, "header": name, "numeric": numeric, "value": None}
            for i, (name, numeric) in enumerate(_headers(header, width))
            if wanted is None or name in wanted
        ],
    )


def _workbook_rows(content: bytes) -> Iterator[tuple]:
    """``(sheet_index, sheet, row_index, cells, error)``; a sheet that breaks off anywhere yields one error row and no other.

    A sheet is read through once before any of its rows is given out, so that no part of a broken one stays.
    """
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        sheets = sheet_parts(book)
        if not sheets:
            yield None, None, None, None, "No sheets found in file"
            return
        shared: list[str] = []
        if "xl/sharedStrings.xml" in book.namelist():
            shared = [shared_text(item) for item in ElementTree.fromstring(book.read("xl/sharedStrings.xml"))]
        dates = date_styles(book)
        for index, (sheet, part) in enumerate(sheets):
            try:
                for _ in sheet_rows(book, part, shared, dates):
                    pass
            except Exception as problem:
                yield index, sheet, None, None, f"Sheet could not be read: {problem}"
                continue
            for row_index, cells in sheet_rows(book, part, shared, dates):
                yield index, sheet, row_index, cells, None


def _decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    columns = ["file_path", "file_name", "sheet_index", "sheet", "row_index", "cells", "error"]

    def frame(rows):
        return pd.DataFrame(rows, columns=columns).astype({"sheet_index": "Int32", "row_index": "Int32"})

    for batch in batches:
        for file in batch.itertuples(index=False):
            rows = []
            try:
                for row in _workbook_rows(bytes(file.content)):
                    rows.append((file.file_path, file.file_name, *row))
                    if len(rows) == _BATCH_ROWS:
                        yield frame(rows)
                        rows = []
            except Exception as problem:
                rows.append((file.file_path, file.file_name, None, None, None, None, f"File could not be opened: {problem}"))
            if rows:
                yield frame(rows)


def read_cells(
    spark: SparkSession,
    folder: str,
    max_mb: float | None = MAX_MB,
    pattern: str = WORKBOOK_FILES,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Rows of every sheet of the workbooks in a folder; files over ``max_mb`` are left out and listed as rejects.

    With ``columns`` only cells under these headers are kept, in sheet order; a sheet that lacks one of
    them keeps those it has.

    ``row_index`` counts from 0 below the header, blank rows included; the header itself is
    row ``HEADER_ROW``. Rows with ``error`` tell of a file or sheet that could not be read.
    """
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .load(folder)
        .filter(F.lit(True) if max_mb is None else F.col("length") <= int(max_mb * 1024 * 1024))
        .select(F.col("path").alias("file_path"), file_name(F.col("path")).alias("file_name"), "content")
        .filter(~F.startswith("file_name", F.lit("~$")))
    )
    rows = files.mapInPandas(_decode, CELL_ROWS)
    if columns is not None:
        rows = rows.withColumn("cells", F.filter("cells", lambda c: c["header"].isin(*columns)))
    return rows


def data_rows(cells: DataFrame, missing: tuple[str, ...] = MISSING) -> DataFrame:
    """Data rows with missing tokens as null; rows without any value are dropped."""
    value = F.transform(
        "cells",
        lambda c: F.struct(
            c["col"].alias("col"),
            c["header"].alias("header"),
            c["numeric"].alias("numeric"),
            F.when(~c["value"].isin(*missing), c["value"]).alias("value"),
        ),
    )
    rows = cells.filter(F.col("row_index") >= 0).withColumn("cells", value)
    return rows.filter(F.exists("cells", lambda c: c["value"].isNotNull()))


def header_rows(cells: DataFrame) -> DataFrame:
    """One row per readable sheet with its header cells in column order."""
    return cells.filter(F.col("row_index") == HEADER_ROW).drop("row_index", "error")


def reject_rows(spark: SparkSession, folder: str, cells: DataFrame, max_mb: float | None = MAX_MB) -> DataFrame:
    """``(file_name, sheet, reason)`` of files and sheets that were not admitted or not readable."""
    unreadable = cells.filter("error is not null").select("file_name", "sheet", F.col("error").alias("reason"))
    if max_mb is None:
        return unreadable
    listed = admit_by_size(list_files(spark, folder, WORKBOOK_FILES), max_mb).filter(~F.col("admitted"))
    too_large = listed.select("file_name", F.lit(None).cast("string").alias("sheet"), "reason")
    return too_large.unionByName(unreadable)
