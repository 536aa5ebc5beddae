"""Workbooks that tasks write from ``part`` and read back: books by brand, sheets by type, blank rows and cells among them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from notewright.operators.census import ingestion_tally, rank_patterns, sheet_columns, sheets_like
from notewright.operators.records import records_from_workbooks
from notewright.plans.registry import query, table
from notewright.session import scratch_path
from notewright.sources.workbook import data_rows, header_rows
from notewright.sources.workbook_format import read_sheets, write_workbooks

_ROWS_OF_A_BOOK = 50_000  # places of a sheet; books of a brand are numbered


def _books(spark: SparkSession, sf_dir: str) -> str:
    """Folder of the written books."""
    size, place = F.col("p_size"), F.col("p_partkey")

    def cell(at: int, header, value, numeric: bool = False):
        kinds = (F.lit(at).alias("col"), header.alias("header"), F.lit(numeric).alias("numeric"))
        return F.struct(*kinds, value.cast("string").alias("value"))

    fourth = F.when(F.col("p_type") == "PROMO", "Price ").otherwise("Retail Price")
    cells = F.array(
        cell(0, F.lit("part name"), F.when(size % 3 != 0, F.concat(F.lit(" "), "p_name"))),
        cell(1, F.lit("Unnamed: 1"), F.when(size % 4 != 0, F.col("p_type"))),
        cell(2, F.lit("Size-Note"), F.when(size % 2 == 0, F.lit("N/A")).otherwise(F.concat(F.lit("<"), size.cast("string"), F.lit("> & co")))),
        cell(3, fourth, F.when(size % 5 != 0, F.col("p_retailprice")), numeric=True),
    )
    book = F.concat("p_brand", F.lit(" "), F.floor(place / _ROWS_OF_A_BOOK).cast("string"), F.lit("_references.xlsx"))
    sheet_index = F.when(F.col("p_type") == "PROMO", 0).otherwise(1).cast("int")  # in the order the sheets are written
    rows = table(spark, sf_dir, "part").select(
        book.alias("file_name"),
        F.struct(sheet_index, "p_type").alias("sheet_index"),
        F.col("p_type").alias("sheet"),
        F.pmod(place, F.lit(_ROWS_OF_A_BOOK)).cast("int").alias("row_index"),
        cells.alias("cells"),
    )
    path = scratch_path(spark, "books")
    write_workbooks(rows, path)
    return path


def _read(spark: SparkSession, sf_dir: str, columns: list[str] | None = None) -> DataFrame:
    """The written books' rows; their many small sheets share partitions."""
    return read_sheets(spark, _books(spark, sf_dir), columns, group_mb="4")


_BOOK_SQL = f"p_brand || ' ' || (p_partkey // {_ROWS_OF_A_BOOK}) || '_references.xlsx'"
_PRICE_SQL = """CASE WHEN p_size % 5 = 0 THEN NULL WHEN p_retailprice = floor(p_retailprice) THEN CAST(CAST(p_retailprice AS BIGINT) AS VARCHAR)
                ELSE CAST(p_retailprice AS VARCHAR) END"""
_ROWS_SQL = f"""SELECT {_BOOK_SQL} AS file_name, p_type AS sheet, CAST(p_partkey % {_ROWS_OF_A_BOOK} AS INTEGER) AS row_index,
        CASE WHEN p_size % 3 <> 0 THEN ' ' || p_name END AS named, CASE WHEN p_size % 4 <> 0 THEN p_type END AS typed,
        CASE WHEN p_size % 2 <> 0 THEN '<' || p_size || '> & co' END AS noted, {_PRICE_SQL} AS price FROM part"""


@query(
    f"""SELECT file_name, sheet, row_index, header, value FROM (
          SELECT file_name, sheet, row_index, unnest(['part name', 'Retail Price']) AS header,
                 unnest([named, CASE WHEN sheet <> 'PROMO' THEN price END]) AS value FROM ({_ROWS_SQL}))
        WHERE value IS NOT NULL"""
)
def workbook_cells(spark, sf_dir):
    """Cells under requested headers, which not every sheet has, at their row numbers of the sheet."""
    rows = data_rows(_read(spark, sf_dir, columns=["part name", "Retail Price", "Nowhere"]))
    cells = rows.select("file_name", "sheet", "row_index", F.explode("cells").alias("cell"))
    return cells.select("file_name", "sheet", "row_index", "cell.header", "cell.value").filter("value IS NOT NULL")


@query(
    f"""SELECT DISTINCT {_BOOK_SQL} AS file_name, p_type AS sheet, 1 AS unlabeled,
               'part name|Size-Note|' || CASE WHEN p_type = 'PROMO' THEN 'Price' ELSE 'Retail Price' END AS columns FROM part"""
)
def workbook_headers(spark, sf_dir):
    """Labeled headers of every sheet, read from the files."""
    sheets = sheet_columns(header_rows(_read(spark, sf_dir).withColumn("error", F.lit(None))))
    return sheets.select("file_name", "sheet", F.col("unlabeled"), F.array_join("columns", "|").alias("columns"))


@query(
    f"""SELECT CASE WHEN p THEN 'Price ' ELSE 'Retail Price' END AS last, row_number() OVER (ORDER BY n DESC, f) AS rank, n AS count
        FROM (SELECT p_type = 'PROMO' AS p, count(DISTINCT ({_BOOK_SQL}, p_type)) AS n, min(({_BOOK_SQL}, p_type)) AS f FROM part GROUP BY p)"""
)
def workbook_patterns(spark, sf_dir):
    """Header patterns of the written books by how many sheets share them."""
    sheets = sheet_columns(header_rows(_read(spark, sf_dir).withColumn("error", F.lit(None))))
    ranks = rank_patterns(sheets, ("file_name", "sheet"))
    return ranks.select(F.element_at("labels", -1).alias("last"), "rank", "count")


@query(f"SELECT DISTINCT {_BOOK_SQL} AS file_name, p_type AS sheet FROM part WHERE p_type <> 'PROMO'")
def workbook_exact_columns(spark, sf_dir):
    """Sheets whose labeled headers are exactly these, in this order."""
    sheets = sheet_columns(header_rows(_read(spark, sf_dir).withColumn("error", F.lit(None))))
    return sheets_like(sheets, ["part name", "Size-Note", "Retail Price"]).select("file_name", "sheet")


@query(
    f"""SELECT file_name, sheet, count(*) AS rows_read, count(*) FILTER (WHERE written) AS rows_written,
               count(*) FILTER (WHERE NOT written) AS rows_skipped, 1 AS unlabeled
        FROM (SELECT *, named IS NOT NULL OR noted IS NOT NULL OR price IS NOT NULL AS written FROM ({_ROWS_SQL})
              WHERE named IS NOT NULL OR typed IS NOT NULL OR noted IS NOT NULL OR price IS NOT NULL) GROUP BY ALL"""
)
def workbook_ingestion(spark, sf_dir):
    """Rows read, written and skipped of every sheet of the written books."""
    cells = _read(spark, sf_dir)
    rows = data_rows(cells)
    sheets = sheet_columns(header_rows(cells.withColumn("error", F.lit(None))))
    return ingestion_tally(rows, records_from_workbooks(rows), sheets)


@query(
    f"""SELECT replace(file_name, '_references.xlsx', '') AS id, sheet, row_index,
               array_to_string(list_filter([CASE WHEN named IS NOT NULL THEN 'Part Name=' || trim(named) END,
                   CASE WHEN noted IS NOT NULL THEN 'Size Note=' || noted END,
                   CASE WHEN price IS NOT NULL THEN CASE WHEN sheet = 'PROMO' THEN 'Price=' ELSE 'Retail Price=' END || price END],
                   lambda x: x IS NOT NULL), '|') AS text
        FROM ({_ROWS_SQL}) WHERE named IS NOT NULL OR noted IS NOT NULL OR price IS NOT NULL"""
)
def workbook_records(spark, sf_dir):
    """Records of the written books."""
    records = records_from_workbooks(data_rows(_read(spark, sf_dir)))
    pairs = F.transform(F.map_entries("text"), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return records.select("id", "sheet", F.col("metadata.row_index").alias("row_index"), F.array_join(pairs, "|").alias("text"))
