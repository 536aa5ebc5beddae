"""Record files, catalogues and flat exports.

Writers never touch their input. A partition column gives the folder layout. Rows are dealt
to tasks by ranges of dataset and order, into even shares however unequal the datasets are,
and ordered inside each task, so the part files of a dataset follow each other in record
order: file name and place in the file give the order back. Without an order rows are
written where they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEEP_NULLS = {"ignoreNullFields": "false"}


def pretty_json(value: Column) -> Column:
    """Indented JSON over several lines; top-level braces stand at the line start."""
    return F.to_json(value, {"pretty": "true", **KEEP_NULLS})


def compact_json(value: Column) -> Column:
    return F.to_json(value, KEEP_NULLS)


Order = str | tuple[str, ...] | None


def _write_text(frame: DataFrame, path: str, folder: str, order: Order, text: Column, mode: str) -> None:
    named = frame.withColumn("dataset", F.col(folder)).withColumn("value", text)
    columns = ["dataset", *([order] if isinstance(order, str) else order or ())]
    named = named.repartitionByRange(*columns) if order else named
    named = named.sortWithinPartitions(*columns)
    named.select("dataset", "value").write.mode(mode).partitionBy("dataset").text(path)


def write_pretty(
    records: DataFrame,
    path: str,
    folder: str = "id",
    order: Order = "ord",
    fields: tuple[str, ...] | None = None,
    mode: str = "errorifexists",
) -> None:
    """Pretty records, one folder per workbook id (or another column).

    Without ``fields`` a record has id, sheet, text and metadata, and its per-column values
    under ``columns`` where the frame has them.
    """
    if fields is None:
        fields = ("id", "sheet", "text", "metadata", *(["columns"] if "columns" in records.columns else []))
    _write_text(records, path, folder, order, pretty_json(F.struct(*fields)), mode)


def write_compact(
    records: DataFrame,
    path: str,
    folder: str = "dataset",
    order: Order = "ord",
    fields: tuple[str, ...] = ("id", "sheet", "text"),
    mode: str = "errorifexists",
) -> None:
    """Compact records, one object per line, one folder per dataset."""
    _write_text(records, path, folder, order, compact_json(F.struct(*fields)), mode)


def write_json_text(
    objects: DataFrame,
    path: str,
    json: str,
    folder: str = "dataset",
    order: Order = "ord",
    mode: str = "errorifexists",
) -> None:
    """JSON that is text already, one object per line, one folder per dataset."""
    _write_text(objects, path, folder, order, F.col(json), mode)


def write_catalogues(catalogue: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Sidecars ``{"text": {"text_fields": [...]}}``, one folder per dataset; none for empty field lists."""
    content = F.struct(F.struct("text_fields").alias("text"))
    filled = catalogue.filter(F.size("text_fields") > 0)
    filled.select("dataset", pretty_json(content).alias("value")).write.mode(mode).partitionBy("dataset").text(path)


def write_flat(frame: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Flat columns as CSV with a header and no index."""
    frame.write.mode(mode).option("header", "true").option("escape", '"').csv(path)
