"""Summaries of record sets and of processing runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def length_statistics(records: DataFrame, length: Column, by: Sequence[str] = ()) -> DataFrame:
    """Mean, interpolated median, minimum, maximum and sum of a length; zeros for no records.

    Rows are first reduced to a histogram of lengths, so the exact median never needs
    all rows in one place.
    """
    histogram = records.groupBy(*by, length.cast("bigint").alias("__length")).agg(F.count(F.lit(1)).alias("__n"))
    value, weight = F.col("__length"), F.col("__n")

    def or_zero(column: Column, kind: str) -> Column:
        return F.coalesce(column, F.lit(0)).cast(kind)

    return histogram.groupBy(*by).agg(
        or_zero(F.sum(value * weight) / F.sum(weight), "double").alias("average_text_length"),
        or_zero(F.percentile(value, 0.5, weight), "double").alias("median_text_length"),
        or_zero(F.min(value), "bigint").alias("min_text_length"),
        or_zero(F.max(value), "bigint").alias("max_text_length"),
        or_zero(F.sum(value * weight), "bigint").alias("total_characters"),
    )


def distinct_files(records: DataFrame, file: Column) -> DataFrame:
    """Sorted distinct file names, one per row."""
    return records.select(file.alias("file_name")).distinct().orderBy("file_name")


def data_overview(records: DataFrame, file: Column, sheet: Column) -> DataFrame:
    """One row: distinct files, distinct sheets (file and sheet together) and records."""
    pairs = (
        records.groupBy(file.alias("file"), sheet.alias("sheet"))
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("file")
        .agg(F.count(F.lit(1)).alias("sheets"), F.sum("n").alias("n"))
    )
    return pairs.agg(
        F.count(F.lit(1)).alias("total_files"),
        F.coalesce(F.sum("sheets"), F.lit(0)).alias("total_sheets"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_records"),
    )


def quality_rates(status: DataFrame, ok: Column, error: Column, warning: Column, by: Sequence[str] = ()) -> DataFrame:
    """Success percentage and error and warning counts over a table of outcomes."""
    done, skipped = F.count_if(ok), F.count_if(~ok)
    return status.groupBy(*by).agg(
        (done / F.greatest(F.lit(1), done + skipped) * 100).alias("processing_success_rate"),
        F.lit(100.0).alias("target_sheets_ratio"),
        F.count_if(error).alias("error_count"),
        F.count_if(warning).alias("warning_count"),
    )


def processing_summary(files: DataFrame, seconds: float | None = None) -> DataFrame:
    """One row over per-file outcomes ``(processed, sheets, records, unlabeled)``.

    ``seconds`` is the wall-clock time of the run, measured by the caller.
    """
    processed = F.count_if("processed")
    records = F.coalesce(F.sum("records"), F.lit(0))
    elapsed = F.lit(None if seconds is None else float(seconds)).cast("double")
    return files.agg(
        F.count(F.lit(1)).alias("files_found"),
        processed.alias("files_processed"),
        F.count_if(~F.col("processed")).alias("files_skipped"),
        F.coalesce(F.sum("sheets"), F.lit(0)).alias("total_sheets_processed"),
        records.alias("total_records_created"),
        F.coalesce(F.sum("unlabeled"), F.lit(0)).alias("total_unlabeled_columns_filtered"),
        (records / F.greatest(F.lit(1), processed)).alias("average_records_per_file"),
        elapsed.alias("processing_time_seconds"),
        (processed / F.when(elapsed > 1, elapsed).otherwise(F.lit(1.0))).alias("files_per_second"),
    )
