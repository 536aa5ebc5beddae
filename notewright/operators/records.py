"""Rows of cells or table rows into records, and record-level projections."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notewright.functions.jsontext import has_key, is_json_object, last_wins_map
from notewright.functions.text import (
    clean_text,
    has_content,
    is_labeled,
    snake_key,
    strip,
    title_case,
    utc_now_text,
    word_count,
    workbook_id,
)

_ENTRY = "array<struct<header:string,key:string,value:string>>"


def cell_entries(cells: Column, keep_indent: bool = False) -> Column:
    """``(header, key, value)`` of the labeled cells of a workbook row, cleaned."""
    labeled = F.filter(cells, lambda c: is_labeled(c["header"], c["numeric"]))

    def entry(cell: Column) -> Column:
        header = strip(cell["header"])
        return F.struct(
            header.alias("header"),
            title_case(header).alias("key"),
            clean_text(cell["value"], header, keep_indent).alias("value"),
        )

    return F.transform(labeled, entry)


def column_entries(columns: Sequence[str], keep_indent: bool = False) -> Column:
    """``(header, key, value)`` of table columns; header decisions are made once, on the driver."""
    return F.array(
        *[
            F.struct(
                F.lit(name).alias("header"),
                title_case(F.lit(name)).alias("key"),
                clean_text(F.col(name), name, keep_indent).alias("value"),
            )
            for name in columns
        ]
    ).cast(_ENTRY)


def cell_content(cells: Column) -> Column:
    """Whether any labeled cell of a workbook row has content."""
    return F.exists(cells, lambda c: is_labeled(c["header"], c["numeric"]) & has_content(c["value"]))


def column_content(columns: Sequence[str]) -> Column:
    """Whether any of the table columns has content."""
    found = F.lit(False)
    for name in columns:
        found = found | has_content(F.col(name))
    return found


def _total(values: Column, measure) -> Column:
    return F.aggregate(values, F.lit(0), lambda total, value: total + measure(value))


def with_record(rows: DataFrame, entries: Column, content: Column) -> DataFrame:
    """Add ``text``, ``columns`` and the text part of the metadata; rows without content are dropped.

    ``content`` tells whether any entry is non-empty. It is tested before cleaning: a filter
    on the cleaned entries would be pushed below them and clean every row twice.

    Headers that read alike after title-casing share one key: the last value stays, but
    every non-empty cell is counted. ``columns`` holds all labeled cells under snake-case
    names, null where empty, apart from the metadata so that neither hides the other.
    """
    return (
        rows.filter(content)
        .withColumn("__all", entries)
        .withColumn("__filled", F.filter("__all", lambda e: e["value"] != ""))
        .withColumn("text", last_wins_map(F.col("__filled")))
        .withColumn(
            "columns",
            last_wins_map(
                F.transform(
                    "__all",
                    lambda e: F.struct(
                        snake_key(e["header"]).alias("key"), F.nullif(e["value"], F.lit("")).alias("value")
                    ),
                )
            ),
        )
        .withColumn("total_labeled_columns", F.size("__all"))
        .withColumn("non_empty_columns", F.size("__filled"))
        .withColumn("columns_used", F.transform("__filled", lambda e: e["header"]))
        .withColumn("text_length", _total(F.map_values("text"), F.length))
        .withColumn("word_count", _total(F.map_values("text"), word_count))
        .drop("__all", "__filled")
    )


def records_from_workbooks(rows: DataFrame, keep_indent: bool = False) -> DataFrame:
    """Workbook rows as records ``(file_path, ord, id, sheet, text, metadata, columns)``."""
    built = with_record(rows, cell_entries(F.col("cells"), keep_indent), cell_content(F.col("cells")))
    order = F.shiftleft(F.col("sheet_index").cast("bigint"), 32).bitwiseOR(F.col("row_index").cast("bigint"))
    return built.select(
        "file_path",
        order.alias("ord"),
        workbook_id(F.col("file_name")).alias("id"),
        "sheet",
        "text",
        F.struct(
            "file_name",
            F.col("file_name").alias("file_path"),
            F.col("sheet").alias("sheet_name"),
            "row_index",
            "total_labeled_columns",
            "non_empty_columns",
            "columns_used",
            "text_length",
            "word_count",
            utc_now_text().alias("processing_timestamp"),
        ).alias("metadata"),
        "columns",
    )


def records_from_table(
    table: DataFrame,
    columns: Sequence[str],
    order: str,
    id: Column,
    sheet: Column,
    dataset: str,
    clean: bool = True,
) -> DataFrame:
    """Table rows as records. Without ``clean`` the values enter ``text`` unchanged, nulls left out."""
    base = table.withColumn("ord", F.col(order).cast("bigint")).withColumn("id", id.cast("string"))
    base = base.withColumn("sheet", sheet.cast("string")).withColumn("dataset", F.lit(dataset))
    if clean:
        built = with_record(base, column_entries(columns), column_content(columns))
        return built.select(
            "dataset", "ord", "id", "sheet", "text", "columns", "columns_used", "total_labeled_columns",
            "non_empty_columns", "text_length", "word_count",
        )
    keys = F.array(*[title_case(F.lit(c)) for c in columns])
    values = F.array(*[F.col(c).cast("string") for c in columns])
    text = F.map_filter(F.map_from_arrays(keys, values), lambda _, value: value.isNotNull())
    return base.select("dataset", "ord", "id", "sheet", text.alias("text"))


def valid_for_embedding(records: DataFrame) -> DataFrame:
    """Records that carry both ``id`` and ``text``."""
    return records.filter("has_id and has_text")


def trim_objects(objects: DataFrame, raw: str = "raw") -> DataFrame:
    """Compact ``{id, sheet, text}`` from JSON text, as column ``trimmed``.

    Objects that do not parse are salvaged when the three values can still be located;
    rows that give nothing are left to ``trim_rejects``.
    """
    trimmed = _with_trimmed(objects, raw)
    return trimmed.select(*objects.columns, F.explode(F.array_compact(F.array("__trimmed"))).alias("trimmed"))


def trim_rejects(objects: DataFrame, raw: str = "raw") -> DataFrame:
    """The rows of which ``trim_objects`` makes nothing."""
    return _with_trimmed(objects, raw).filter("__trimmed is null").select(*objects.columns)


def _with_trimmed(objects: DataFrame, raw: str) -> DataFrame:
    value = F.col(raw)
    typed = F.from_json(value, "struct<id: variant, sheet: variant, text: variant>")
    # The variant form would sort the keys of an object; its text form keeps them in order.
    text_json = F.when(F.schema_of_variant("__typed.text") == "STRING", F.to_json("__typed.text")).otherwise(
        F.coalesce(F.col("__text"), F.lit("null"))
    )
    whole = F.concat(
        F.lit('{"id":'), F.to_json("__typed.id"), F.lit(',"sheet":'), F.to_json("__typed.sheet"),
        F.lit(',"text":'), text_json, F.lit("}"),
    )
    complete = has_key(value, "id") & has_key(value, "sheet") & has_key(value, "text")
    trimmed = F.when(is_json_object(value), F.when(complete, whole)).otherwise(_salvage(value))
    return (
        objects.withColumn("__typed", typed)
        .withColumn("__text", F.from_json(value, "struct<text: string>")["text"])
        .withColumn("__trimmed", trimmed)
    )


_QUOTED = r'"((?:[^"\\]|\\.)*+)"'
_SKIP = r"[^:]*:[ \t\r\n]*"
# Pieces of broken JSON text: escaped characters, quotes, braces, and runs of anything else.
_PIECES = r'(?s)\\.|["{}]|[^"\\{}]++|\\'


def _first_object(value: Column) -> Column:
    """The object that a text starts with, its braces matched at any depth outside of strings; null if it does not end."""

    def step(state: Column, piece: Column) -> Column:
        quoted = F.when(piece == '"', ~state["quoted"]).otherwise(state["quoted"])
        change = F.when(state["quoted"], 0).when(piece == "{", 1).when(piece == "}", -1).otherwise(0)
        depth = (state["depth"] + change).cast("int")
        taken = F.struct(
            depth.alias("depth"), (state["size"] + F.length(piece)).cast("int").alias("size"), quoted.alias("quoted"), (depth == 0).alias("done")
        )
        return F.when(state["done"], state).otherwise(taken)

    start = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("size"), F.lit(False).alias("quoted"), F.lit(False).alias("done"))
    end = F.aggregate(F.regexp_extract_all(value, F.lit(_PIECES), F.lit(0)), start, step)
    return F.when(end["done"], F.substr(value, F.lit(1), end["size"]))


def _salvage(value: Column) -> Column:
    located = rf'(?s)"id"{_SKIP}{_QUOTED}.*?"sheet"{_SKIP}{_QUOTED}.*?"text"{_SKIP}(\{{.*+)'

    def unescaped(group: int) -> Column:
        return F.regexp_replace(F.regexp_extract(value, located, group), r"(?s)\\(.)", "$1")

    text = F.regexp_replace(_first_object(F.regexp_extract(value, located, 3)), r"[\r\n]+[ \t]*", "")
    head = F.to_json(F.struct(unescaped(1).alias("id"), unescaped(2).alias("sheet")))
    whole = F.concat(F.substr(head, F.lit(1), F.length(head) - 1), F.lit(',"text":'), text, F.lit("}"))
    return F.when(is_json_object(text), whole)
