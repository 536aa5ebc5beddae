"""Column patterns of sheets and ingestion tallies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from notewright.functions.text import is_labeled, normal_header
from notewright.operators.numbering import number_sorted
from notewright.operators.sizing import join_measured


def sheet_columns(headers: DataFrame) -> DataFrame:
    """Header rows with their labeled headers and the number of the others.

    ``labels`` are the headers as they stand, ``columns`` the same normalised for comparison.
    """
    labeled = F.filter("cells", lambda c: is_labeled(c["header"], c["numeric"]))
    return (
        headers.withColumn("__labeled", labeled)
        .withColumn("labels", F.transform("__labeled", lambda c: c["header"]))
        .withColumn("columns", F.transform("__labeled", lambda c: normal_header(c["header"], c["numeric"])))
        .withColumn("unlabeled", F.size("cells") - F.size("__labeled"))
        .drop("__labeled")
    )


def rank_patterns(sheets: DataFrame, first_seen: Sequence[str] = ("file_name", "sheet_index")) -> DataFrame:
    """``(rank, labels, count)``: how many sheets share an ordered header list.

    Ranked by count, ties by the first sheet seen. The sheets of a pattern are rows of
    ``pattern_sheets``, never a list inside one row.
    """
    patterns = sheets.groupBy("labels").agg(
        F.count(F.lit(1)).alias("count"), F.min(F.struct(*first_seen)).alias("first_seen")
    )
    ranked = number_sorted(patterns, [F.desc("count"), F.asc("first_seen")], "rank")
    return ranked.select((F.col("rank") + 1).alias("rank"), "labels", "count")


def pattern_sheets(sheets: DataFrame, ranks: DataFrame) -> DataFrame:
    """Every sheet with the rank of its pattern."""
    return join_measured(sheets, ranks.select("rank", "labels"), "labels")


def sheets_like(sheets: DataFrame, columns: Sequence[str | int | float]) -> DataFrame:
    """Sheets whose labeled headers equal the given list, order included."""
    names = [str(int(c)) if isinstance(c, (int, float)) else str(c).strip() for c in columns]
    return sheets.filter(F.col("columns") == F.array(*[F.lit(name) for name in names]).cast("array<string>"))


def target_rows(rows: DataFrame, targets: DataFrame, keys: Sequence[str] = ("file_name", "sheet")) -> DataFrame:
    """Rows whose ``(file, sheet)`` is on the target list."""
    return join_measured(rows, targets.select(*keys).distinct(), list(keys), "left_semi")


def sheets_by_file(sheets: DataFrame) -> DataFrame:
    """One row per file: ``(file_name, n_sheets)``. The sheets themselves are the rows of ``sheets``."""
    return sheets.groupBy("file_name").agg(F.count(F.lit(1)).alias("n_sheets"))


def ingestion_tally(rows: DataFrame, records: DataFrame, sheets: DataFrame) -> DataFrame:
    """Per file and sheet: rows read, records written, rows skipped, unlabeled columns left out."""
    key = ["file_name", "sheet"]
    read = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("rows_read"))
    written = (
        records.groupBy(F.col("metadata.file_name").alias("file_name"), "sheet")
        .agg(F.count(F.lit(1)).alias("rows_written"))
    )
    zero = F.lit(0)
    return (
        sheets.select(*key, "unlabeled")
        .join(read, key, "left")
        .join(written, key, "left")
        .select(
            *key,
            F.coalesce("rows_read", zero).alias("rows_read"),
            F.coalesce("rows_written", zero).alias("rows_written"),
            (F.coalesce("rows_read", zero) - F.coalesce("rows_written", zero)).alias("rows_skipped"),
            "unlabeled",
        )
    )
