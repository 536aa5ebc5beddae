"""Filters, paging and projections of one dataset of records."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from notewright.functions.arguments import requested_fields, split_filters, within
from notewright.functions.text import ellipsis, has_text
from notewright.operators.numbering import CHUNK_BITS
from notewright.operators.sizing import join_measured

# Up to here a page is a plain top-k.
SHALLOW_ROWS = 50_000


def text_filter(field: str, needle: str, text: str = "text") -> Column:
    """Text field holds the needle, in any case."""
    return has_text(F.col(text)[field], needle)


def record_value(records: DataFrame, field: str) -> Column:
    """A column of the records, or a key that the reader found beside the known ones."""
    return F.col(field) if field in records.columns or "other" not in records.columns else F.col("other")[field]


def metadata_filter(records: DataFrame, field: str, needle: str) -> Column:
    """Metadata value, as text, holds the needle; nested values are searched as JSON."""
    value = record_value(records, field)
    if field in records.columns and isinstance(records.schema[field].dataType, (T.StructType, T.MapType, T.ArrayType)):
        value = F.to_json(value)
    return has_text(value.cast("string"), needle)


def any_field_has(fields: Sequence[str], needle: str, text: str = "text") -> Column:
    """Any of the catalogue's fields holds the needle."""
    return F.exists(F.map_entries(text), lambda e: e["key"].isin(*fields) & has_text(e["value"], needle))


def restrict_text(fields: Sequence[str], text: str = "text") -> Column:
    """``text`` cut to the given fields that are present, in the given order."""
    present = F.filter(F.array(*[F.lit(f) for f in dict.fromkeys(fields)]), lambda f: F.map_contains_key(text, f))
    return F.map_from_arrays(present, F.transform(present, lambda f: F.col(text)[f]))


def order_columns(order: str | Sequence[str]) -> list[str]:
    """Columns that together put records in file order, such as the file and the place in it."""
    return [order] if isinstance(order, str) else list(order)


def page_rows(
    frame: DataFrame, order: str | Sequence[str], offset: int, limit: int, chunk_bits: int = CHUNK_BITS
) -> DataFrame:
    """Rows ``[offset, offset + limit)`` in the order of an integer column, or of columns of which the last is one.

    A shallow page is a top-k. For a deep one the rows per chunk of order values are counted
    first; the page is then a top-k over the few chunks it touches, and the range of orders
    reaches the scan as a filter. Rows must differ in their order.
    """
    columns = order_columns(order)
    if offset + limit > SHALLOW_ROWS:
        leading, last = columns[:-1], columns[-1]
        chunks = frame.groupBy(*leading, F.shiftright(F.col(last).cast("bigint"), chunk_bits).alias("chunk")).agg(
            F.count(F.lit(1)).alias("rows"), F.min(last).alias("low"), F.max(last).alias("high")
        )
        window = Window.orderBy(*leading, "chunk").rowsBetween(Window.unboundedPreceding, -1)
        touched = chunks.withColumn("before", F.coalesce(F.sum("rows").over(window), F.lit(0))).filter(
            (F.col("before") < offset + limit) & (F.col("before") + F.col("rows") > offset)
        )
        first = F.struct(*leading, F.col("low").alias(last))
        final = F.struct(*leading, F.col("high").alias(last))
        low, high, skipped = touched.agg(F.min(first), F.max(final), F.min("before")).first()
        if low is None:
            return frame.filter(F.lit(False))
        for name in leading:
            frame = frame.filter(F.col(name).between(low[name], high[name]))
        place = F.struct(*columns)
        bounds = [F.struct(*[F.lit(row[name]).alias(name) for name in columns]) for row in (low, high)]
        inside = F.col(last).between(low[last], high[last]) if not leading else (place >= bounds[0]) & (place <= bounds[1])
        frame, offset = frame.filter(inside), offset - skipped
    return frame.orderBy(*columns).offset(offset).limit(limit)


def first_per_id(records: DataFrame, order: str | Sequence[str] = "ord", id: str = "id") -> DataFrame:
    """First record of every id.

    Finding the first place reads narrow columns; whole records are only touched to
    keep those at a first place, never sorted.
    """
    columns = order_columns(order)
    firsts = records.groupBy(id).agg(F.min(F.struct(*columns)).alias("__first")).select(id, "__first.*")
    return join_measured(records, firsts, [id, *columns], "left_semi", skewed=False)


def invalid_field_names(requested: Column, available: Column) -> Column:
    """Requested names that are not available."""
    return F.array_except(requested, available)


@dataclass(frozen=True)
class Dataset:
    """Records of one file or table together with its field catalogue."""

    records: DataFrame
    name: str
    text_fields: Sequence[str]
    metadata_fields: Sequence[str] = ("id", "sheet")
    order: str | Sequence[str] = "ord"

    def matching(self, query: str | None = None, filters: Mapping[str, Any] | None = None) -> DataFrame:
        """Records that meet all filters and the full-text query. Unknown filter names are ignored."""
        text, metadata = split_filters(filters or {}, self.text_fields, self.metadata_fields)
        found = self.records
        for field, needle in text.items():
            found = found.filter(text_filter(field, needle))
        for field, needle in metadata.items():
            found = found.filter(metadata_filter(found, field, needle))
        return found.filter(any_field_has(self.text_fields, query)) if query else found

    def formatted(self, found: DataFrame, fields: Sequence[str] | None = None) -> DataFrame:
        """``id, sheet, text, metadata`` with text cut to the requested (else all known) fields."""
        other = [name for name in self.metadata_fields if name not in ("id", "sheet")]
        metadata = F.struct(*[record_value(found, name).alias(name) for name in other]) if other else F.lit(None).cast("map<string,string>")
        return found.select("id", "sheet", restrict_text(fields or self.text_fields).alias("text"), metadata.alias("metadata"))

    def search(
        self,
        query: str | None = None,
        filters: Mapping[str, Any] | None = None,
        fields: str | Sequence[str] | None = None,
        limit: int = 20,
        offset: int = 0,
    ) -> DataFrame:
        """Formatted records from ``offset`` on, in file order."""
        within("limit", limit, 1, 100)
        within("offset", offset, 0)
        wanted = requested_fields(fields, self.text_fields)
        return self.formatted(page_rows(self.matching(query, filters), self.order, offset, limit), wanted)

    def page(
        self,
        page: int = 1,
        page_size: int = 20,
        fields: str | Sequence[str] | None = None,
        query: str | None = None,
        filters: Mapping[str, Any] | None = None,
    ) -> DataFrame:
        """Formatted records of one page; past the end it is empty."""
        within("page", page, 1)
        within("page_size", page_size, 1, 100)
        return self.search(query, filters, fields, page_size, (page - 1) * page_size)

    def page_info(
        self, page_size: int = 20, query: str | None = None, filters: Mapping[str, Any] | None = None
    ) -> DataFrame:
        """One row: ``total`` and ``total_pages`` of the filtered records."""
        within("page_size", page_size, 1, 100)
        total = F.count(F.lit(1))
        return self.matching(query, filters).agg(
            total.alias("total"), F.ceil(total / page_size).cast("bigint").alias("total_pages")
        )

    def find(self, query: str = "", filters: Mapping[str, Any] | None = None, limit: int = 5) -> DataFrame:
        """Whole records, first ``limit`` in file order."""
        within("limit", limit, 1)
        return self.matching(query, filters).orderBy(*order_columns(self.order)).limit(limit)

    def by_id(self, record_id: str) -> DataFrame:
        """First record with exactly this id, formatted; empty when there is none."""
        return self.formatted(self.full_record(record_id))

    def full_record(self, record_id: str) -> DataFrame:
        """First record with exactly this id, whole; empty when there is none."""
        return self.records.filter(F.col("id") == record_id).orderBy(*order_columns(self.order)).limit(1)

    def id_pattern(self, pattern: str, limit: int = 10) -> DataFrame:
        """Whole records whose id holds the pattern, in any case."""
        found = self.records.filter(has_text(F.col("id"), pattern))
        within("limit", limit, 1)
        return found.orderBy(*order_columns(self.order)).limit(limit)

    def preview(self, limit: int = 10) -> DataFrame:
        """First records with their metadata and the start of the catalogue's first field."""
        within("limit", limit, 1)
        columns = [F.coalesce("id", F.lit("N/A")).alias("id")]
        columns += [record_value(self.records, name).alias(name) for name in self.metadata_fields if name != "id"]
        if self.text_fields:
            first = self.text_fields[0]
            columns.append(ellipsis(F.col("text")[first], 100).alias(f"{first}_preview"))
        return self.records.orderBy(*order_columns(self.order)).limit(limit).select(*columns)

    def project(self, names: Mapping[str, str]) -> DataFrame:
        """Chosen text fields of all records as columns: ``{column: field}``."""
        return self.records.select(*[F.col("text")[field].alias(column) for column, field in names.items()])

    def schema_info(self) -> DataFrame:
        """One row: name, fields, record count and first record."""
        return self.records.agg(
            F.lit(self.name).alias("current_file"),
            F.array(*[F.lit(f) for f in self.text_fields]).cast("array<string>").alias("text_fields"),
            F.array(*[F.lit(f) for f in self.metadata_fields]).cast("array<string>").alias("metadata_fields"),
            F.count(F.lit(1)).alias("total_records"),
            F.min_by(F.struct(*self.records.columns), F.struct(*order_columns(self.order))).alias("sample_record"),
        )
