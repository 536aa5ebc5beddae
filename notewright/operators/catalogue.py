"""Field catalogues, key discovery, counts and dataset status."""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from notewright.functions.jsontext import last_at_path, path_literal
from notewright.operators.sizing import join_measured


def field_names(records: DataFrame, group: str = "dataset") -> DataFrame:
    """Distinct ``(dataset, field)``. Keys are de-duplicated inside each task before the shuffle."""
    return records.select(group, F.explode(F.map_keys("text")).alias("field")).distinct()


def field_catalogue(records: DataFrame, group: str = "dataset") -> DataFrame:
    """``(dataset, text_fields)`` with the sorted field names; datasets without fields are absent."""
    names = field_names(records, group)
    return names.groupBy(group).agg(F.array_sort(F.collect_list("field")).alias("text_fields"))


def attach_catalogue(records: DataFrame, catalogue: DataFrame, group: str = "dataset") -> DataFrame:
    """Records with the field list of their dataset; records without a catalogue are left out."""
    return join_measured(records, catalogue, group)


def record_counts(records: DataFrame, group: str = "dataset", grand_total: bool = False) -> DataFrame:
    """Total, valid and failed records; valid means that ``text`` is an object.

    Records read from files also count as embeddable when they carry ``id`` and ``text``.
    ``grand_total`` adds a row over all datasets, under a null name.
    """
    grouped = records.rollup(group) if grand_total else records.groupBy(group)
    counts = [
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("text").isNotNull()).alias("valid"),
        F.count_if(F.col("text").isNull()).alias("failed"),
    ]
    if "has_id" in records.columns:
        counts.append(F.count_if(F.col("has_id") & F.col("has_text")).alias("embeddable"))
    return grouped.agg(*counts)


def compare_datasets(records: DataFrame, group: str = "dataset") -> DataFrame:
    """``(dataset, records, fields, field_names)``, one row per dataset."""
    counts = records.groupBy(group).agg(F.count(F.lit(1)).alias("records"))
    names = field_catalogue(records, group).withColumnRenamed("text_fields", "field_names")
    no_names = F.array().cast("array<string>")
    return counts.join(names, group, "left").select(
        group,
        "records",
        F.size(F.coalesce("field_names", no_names)).alias("fields"),
        F.coalesce("field_names", no_names).alias("field_names"),
    )


def dataset_status(records: DataFrame, group: str = "dataset", order: str | Sequence[str] = "ord") -> DataFrame:
    """Per dataset: record count and the first record, by columns that differ between records."""
    rest = [c for c in records.columns if c != group]
    columns = [order] if isinstance(order, str) else list(order)
    total, first = F.count(F.lit(1)).alias("total_records"), F.min(F.struct(*columns)).alias("__first")
    counts = records.groupBy(group).agg(total, first).select(group, "total_records", "__first.*")
    first = join_measured(records, counts, [group, *columns], skewed=False)
    return first.select(group, "total_records", F.struct(*rest).alias("sample_record"))


def _type_paths(text: str) -> list[str]:
    """Dotted object paths in a type text such as ``OBJECT<a: BIGINT, b: OBJECT<c: STRING>>``."""
    paths, at = [], 0

    def name() -> str:
        nonlocal at
        if text[at] != "`":
            end = text.index(":", at)
            found, at = text[at:end], end
            return found
        found, at = "", at + 1
        while True:
            end = text.index("`", at)
            found += text[at:end]
            at = end + 1
            if text[at : at + 1] != "`":
                return found
            found, at = found + "`", at + 1

    def skip() -> None:
        """Pass over a type that is not entered."""
        nonlocal at
        depth = 0
        while at < len(text):
            mark = text[at]
            if mark == "`":
                name()
                continue
            if mark in "<(":
                depth += 1
            elif mark in ">)":
                if depth == 0:
                    return
                depth -= 1
            elif mark == "," and depth == 0:
                return
            at += 1

    def members(prefix: str) -> None:
        nonlocal at
        at += len("OBJECT<")
        while text[at] != ">":
            path = prefix + name()
            paths.append(path)
            at += 2
            if text.startswith("OBJECT<", at):
                members(path + ".")
            else:
                skip()
            if text[at] == ",":
                at += 2
        at += 1

    if text.startswith("OBJECT<"):
        members("")
    return paths


def _json_paths(node, prefix: str = "") -> Iterator[str]:
    if isinstance(node, dict):
        for key, value in node.items():
            yield prefix + key
            yield from _json_paths(value, f"{prefix}{key}.")


def _shape_paths(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        found: set[str] = set()
        for shape in batch["shape"].dropna():
            found.update(_json_paths(json.loads(shape)) if shape.startswith("{") else _type_paths(shape))
        yield pd.DataFrame({"path": sorted(found)})


def nested_key_paths(objects: DataFrame, raw: str = "raw") -> DataFrame:
    """Distinct dotted paths of the object keys, intermediate ones included; arrays are not entered.

    One pass: Spark reduces each object to the text of its type and keeps the distinct
    ones, which are few; only those are taken apart. An object the variant parser
    refuses, such as one with a repeated key, stands for itself.
    """
    value = F.col(raw)
    shape = F.coalesce(F.schema_of_variant(F.try_parse_json(value)), F.when(value.rlike(r"^\s*\{"), F.ltrim(value)))
    # No filter on the shape here: it would be pushed below and parse every object twice.
    shapes = objects.select(shape.alias("shape")).distinct()
    return shapes.mapInPandas(_shape_paths, "path string").distinct()


def child_keys(objects: DataFrame, parent: str, raw: str = "raw") -> DataFrame:
    """Distinct keys of the object at a dotted path."""
    value = F.col(raw)
    tree = F.try_parse_json(value)
    keys = F.map_keys(F.try_variant_get(tree, F.lit(path_literal(parent)), "map<string,variant>"))
    keys = F.when(tree.isNotNull(), keys).otherwise(F.json_object_keys(last_at_path(value, parent)))
    return objects.select(F.explode(keys).alias("key")).distinct()
