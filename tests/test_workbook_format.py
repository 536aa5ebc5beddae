import json

import pytest
from books import Date, Error, write_book
from pyspark.sql import functions as F

from notewright.sources.workbook import data_rows, read_cells
from notewright.sources.workbook_format import read_sheets, rejected_sheets, write_workbooks

CELLS = "array<struct<col:int,header:string,numeric:boolean,value:string>>"


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    path = tmp_path_factory.mktemp("books")
    write_book(
        path / "One_references.xlsx",
        {
            "First & <1>": [["Name", None, "Size", "Name"], ["a", 1, 2.5, True], [], ["inline:b", None, Error("#REF!"), Date(45000.25)]],
            "second": [["Name", "Unit"], [None, "x"], ["N/A", None], [" c ", "y", "beyond"]],
            "empty": [],
        },
    )
    write_book(path / "Two.XLSM", {"only": [[7, "Name"], [1, 2]]})
    write_book(path / "~$Two.xlsx", {"lock": [["x"]]})
    (path / "broken.xlsx").write_bytes(b"no archive")
    (path / "notes.txt").write_text("x")
    return path


def rows(frame):
    names = ["file_name", "sheet_index", "sheet", "row_index", "cells"]
    return sorted((r.file_name, r.sheet_index, r.sheet, r.row_index, tuple(map(tuple, r.cells))) for r in frame.select(names).collect())


def test_rows_are_those_of_the_file_reader(spark, folder):
    assert rows(read_sheets(spark, str(folder))) == rows(read_cells(spark, str(folder)).filter("error IS NULL"))


def test_a_partition_per_sheet_or_by_size(spark, folder):
    assert read_sheets(spark, str(folder)).rdd.getNumPartitions() == 4
    assert read_sheets(spark, str(folder), group_mb="1").rdd.getNumPartitions() == 1
    assert rows(read_sheets(spark, str(folder), group_mb="1")) == rows(read_sheets(spark, str(folder)))


@pytest.mark.parametrize("columns", [["Name"], ["Size", "Unit", "Nowhere"], ["Unnamed: 2", "Name.1"], []])
def test_chosen_columns(spark, folder, columns):
    got = data_rows(read_sheets(spark, str(folder), columns))
    assert rows(got) == rows(data_rows(read_cells(spark, str(folder), columns=columns).filter("error IS NULL")))


def test_chosen_sheets_and_files_leave_partitions_out(spark, folder):
    one = read_sheets(spark, str(folder), sheets=json.dumps(["only", "second"]))
    assert one.rdd.getNumPartitions() == 2 and {r[2] for r in rows(one)} == {"only", "second"}
    two = read_sheets(spark, str(folder), files=json.dumps(["Two.XLSM"]))
    assert {r[0] for r in rows(two)} == {"Two.XLSM"}
    assert read_sheets(spark, str(folder), files="[]").collect() == []


def test_a_single_file_and_a_file_uri(spark, folder):
    assert {r[0] for r in rows(read_sheets(spark, str(folder / "Two.XLSM")))} == {"Two.XLSM"}
    assert rows(read_sheets(spark, f"file:{folder}")) == rows(read_sheets(spark, str(folder)))


def test_rejects(spark, folder, tmp_path):
    got = {(r.file_name, r.sheet, r.reason.split(":")[0]) for r in rejected_sheets(spark, str(folder)).collect()}
    assert got == {("broken.xlsx", None, "File could not be opened")}
    large = {r.file_name for r in rejected_sheets(spark, str(folder), max_mb="0.000001").collect()}
    assert large == {"One_references.xlsx", "Two.XLSM", "broken.xlsx"}
    import zipfile

    with zipfile.ZipFile(folder / "One_references.xlsx") as book, zipfile.ZipFile(tmp_path / "half.xlsx", "w") as out:
        for name in book.namelist():
            content = book.read(name)
            out.writestr(name, content[: len(content) // 2] if name.endswith("sheet2.xml") else content)
    bad = [(r.file_name, r.sheet) for r in rejected_sheets(spark, str(tmp_path)).collect()]
    assert bad == [("half.xlsx", "second")]
    assert {r[2] for r in rows(read_sheets(spark, str(tmp_path)))} == {"First & <1>", "empty"}


def test_written_books_read_back(spark, tmp_path):
    data = []
    for file in ("a.xlsx", "b & c.xlsx"):
        for index, sheet in enumerate(["S<1>", "t"]):
            for row in (4, 0, 70000):
                cells = [(0, "Key é", False, f"{sheet}&{row}"), (1, "Unnamed: 1", False, None), (2, "n", True, f"{row}.5")]
                data.append((file, index, sheet, row, cells))
    frame = spark.createDataFrame(data, f"file_name string, sheet_index int, sheet string, row_index int, cells {CELLS}")
    write_workbooks(frame.repartition(5), f"{tmp_path}/out")
    got = read_sheets(spark, f"{tmp_path}/out").filter("row_index >= 0")
    want = [(f, i, s, r, tuple((*c[:2], False, c[3]) for c in cells)) for f, i, s, r, cells in data]
    assert rows(got) == sorted(want)
    assert not list((tmp_path / "out").glob("_*"))
    assert read_cells(spark, f"{tmp_path}/out").filter("error IS NOT NULL").isEmpty()


def test_a_failed_job_leaves_no_book(spark, tmp_path):
    cells = F.from_json(F.lit('[{"col":0,"header":"x","numeric":false,"value":"v"}]'), CELLS)
    rows = spark.range(4).select(
        F.lit("a.xlsx").alias("file_name"), F.lit(0).alias("sheet_index"), F.lit("s").alias("sheet"),
        F.when(F.col("id") == 3, F.raise_error(F.lit("stop")).cast("int")).otherwise(F.col("id").cast("int")).alias("row_index"),
        cells.alias("cells"),
    )
    with pytest.raises(Exception):
        write_workbooks(rows, f"{tmp_path}/out")
    assert not (tmp_path / "out" / "a.xlsx").exists()


def test_an_unknown_table_is_refused(spark, folder):
    with pytest.raises(Exception, match="no such table"):
        read_sheets(spark, str(folder), table="other").count()
