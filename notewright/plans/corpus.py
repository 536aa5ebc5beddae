"""Workbooks to record files, and the jobs that follow on record files."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from notewright.operators.catalogue import field_catalogue
from notewright.operators.census import ingestion_tally, rank_patterns, sheet_columns, sheets_like, target_rows
from notewright.operators.records import records_from_workbooks, trim_objects
from notewright.operators.rewrite import replace_tally, rewrite_objects
from notewright.operators.search import Dataset
from notewright.session import stored
from notewright.sinks.records import write_catalogues, write_json_text, write_pretty
from notewright.sources.catalogue_files import catalogue_fields, read_catalogues
from notewright.sources.files import written_folder
from notewright.sources.jsonl import other_lines, parse_records, read_records, scan_objects
from notewright.sources.objects import TOLERANT
from notewright.sources.workbook import MAX_MB, data_rows, header_rows, read_cells, reject_rows


@dataclass(frozen=True)
class WorkbookCorpus:
    """The tables that come out of a folder of workbooks."""

    cells: DataFrame
    sheets: DataFrame
    rows: DataFrame
    records: DataFrame
    rejects: DataFrame

    @property
    def tally(self) -> DataFrame:
        return ingestion_tally(self.rows, self.records, self.sheets)

    @property
    def patterns(self) -> DataFrame:
        return rank_patterns(self.sheets)


def read_workbooks(spark: SparkSession, folder: str, max_mb: float | None = MAX_MB, keep_indent: bool = False) -> WorkbookCorpus:
    """All workbooks of a folder as records, with headers, rejects and tallies."""
    cells = stored(read_cells(spark, folder, max_mb), "cells")  # decoded once for all that is made of them
    rows = data_rows(cells)
    return WorkbookCorpus(
        cells=cells,
        sheets=sheet_columns(header_rows(cells)),
        rows=rows,
        records=records_from_workbooks(rows, keep_indent),
        rejects=reject_rows(spark, folder, cells, max_mb),
    )


def records_of_pattern(corpus: WorkbookCorpus, columns: Sequence[str], keep_indent: bool = False) -> DataFrame:
    """Records of exactly those sheets whose labeled headers equal ``columns``."""
    rows = target_rows(corpus.rows, sheets_like(corpus.sheets, columns))
    return records_from_workbooks(rows, keep_indent)


def write_pattern(
    corpus: WorkbookCorpus, columns: Sequence[str], out: str, dataset: str, keep_indent: bool = False
) -> DataFrame:
    """Write the records of one header pattern as one dataset; returns them."""
    records = records_of_pattern(corpus, columns, keep_indent).withColumn("dataset", F.lit(dataset))
    order = tuple(name for name in ("id", "sheet_index", "ord") if name in records.columns)
    write_pretty(records, out, folder="dataset", order=order)
    return records


def convert_workbooks(spark: SparkSession, folder: str, out: str, max_mb: float | None = MAX_MB) -> WorkbookCorpus:
    """Write the records of a workbook folder as pretty record files, one folder per workbook."""
    corpus = read_workbooks(spark, folder, max_mb)
    write_pretty(corpus.records, out)
    return corpus


def trim_folder(spark: SparkSession, folder: str, out: str, mode: str = TOLERANT) -> None:
    """Write ``{id, sheet, text}`` of all record files below one folder, one sub-folder per file."""
    write_json_text(trim_objects(scan_objects(spark, folder, mode)), out, "trimmed")


def catalogue_folder(spark: SparkSession, folder: str, out: str, mode: str = "auto") -> DataFrame:
    """Write the field catalogue of every record file; returns the catalogue. What no record came of is in ``scan_rejects``."""
    catalogue = field_catalogue(read_records(spark, folder, mode))
    write_catalogues(catalogue, out)
    return catalogue


def rewrite_folder(
    spark: SparkSession, folder: str, out: str, key: str, search: str, replacement: str, mode: str = "auto"
) -> DataFrame:
    """Find and replace in all record files, written to a new folder; returns the tally per file.

    Objects are rewritten once and kept for both the files and the tally. In files read line
    by line, lines that are no object are written as they are; modes that match braces in
    all files write the objects only.
    """
    rewritten = stored(rewrite_objects(scan_objects(spark, folder, mode), key, search, replacement), "rewritten")
    written = rewritten.select("dataset", "file_path", "ord", "raw")
    if mode in ("auto", "lines"):
        written = written.unionByName(other_lines(spark, folder, mode))
    write_json_text(written, out, "raw", order=("file_path", "ord"))
    return replace_tally(rewritten, grand_total=True)


def load_dataset(spark: SparkSession, path: str, dataset: str, catalogues: str | None = None, mode: str = "auto") -> Dataset:
    """One record file with its catalogue, ready for queries.

    ``path`` is the folder, ``dataset`` the file without its ending, or the dataset as written
    by this library, whose part files follow each other in record order. Without the
    catalogue the load fails. Further keys of the first record can be filtered and are shown.
    """
    fields = catalogue_fields(read_catalogues(spark, catalogues or path), dataset)
    place = f"{path.rstrip('/')}/{{{dataset}.jsonl,{written_folder(dataset)}}}"
    objects = scan_objects(spark, place, mode)
    records = parse_records(objects.withColumn("dataset", F.lit(dataset)))
    records = records.select("dataset", "file_path", "ord", "id", "sheet", "text", "metadata", "other")
    first = records.orderBy("file_path", "ord").select(F.map_keys("other").alias("names")).first()
    found = tuple(first["names"]) if first and first["names"] else ()
    return Dataset(records, dataset, fields, ("id", "sheet", "metadata", *found), ("file_path", "ord"))
