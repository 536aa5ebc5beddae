"""Find and replace inside records and free-form JSON."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_RESULT = "raw string, changed boolean"


def replace_field(records: DataFrame, field: str, search: str, replacement: str, text: str = "text") -> DataFrame:
    """Literal replace in one text field of records; adds ``changed``."""
    value = F.col(text)[field]
    changed = F.coalesce(F.contains(value, F.lit(search)), F.lit(False))
    swapped = F.transform_values(
        text, lambda k, v: F.when(k == field, F.replace(v, F.lit(search), F.lit(replacement))).otherwise(v)
    )
    return records.withColumn("changed", changed).withColumn(text, F.when(F.col("changed"), swapped).otherwise(F.col(text)))


def replace_column(table: DataFrame, column: str, search: str, replacement: str) -> DataFrame:
    """Literal replace in a plain string column; adds ``changed``."""
    changed = F.coalesce(F.contains(column, F.lit(search)), F.lit(False))
    return table.withColumn("changed", changed).withColumn(
        column, F.replace(F.col(column), F.lit(search), F.lit(replacement))
    )


def _swap_members(node, key: str, search: str, replacement: str) -> bool:
    """Replace in every string held under ``key`` at any depth; such a member is not entered."""
    changed, pending = False, [node]
    while pending:
        current = pending.pop()
        if isinstance(current, list):
            pending.extend(current)
        elif isinstance(current, dict):
            for name, value in current.items():
                if name != key:
                    pending.append(value)
                elif isinstance(value, str) and search in value:
                    current[name] = value.replace(search, replacement)
                    changed = True
    return changed


def _holder(node, path: list[str]) -> dict | None:
    """The object that holds the last key of a path, or None when the path does not exist."""
    for name in path[:-1]:
        node = node.get(name) if isinstance(node, dict) else None
    return node if isinstance(node, dict) and path[-1] in node else None


def _swap_at_path(node, path: list[str], search: str, replacement: str) -> bool:
    """Replace in the string at one path of object keys."""
    holder = _holder(node, path)
    value = holder[path[-1]] if holder else None
    if not isinstance(value, str) or search not in value:
        return False
    holder[path[-1]] = value.replace(search, replacement)
    return True


def _compact(node) -> str:
    return json.dumps(node, ensure_ascii=False, separators=(",", ":"))


def replace_in_json(raw: Column, key: str, search: str, replacement: str) -> Column:
    """Struct ``(raw, changed)``: JSON text after the replacement, compact where it changed.

    A key with dots is a path from the root, one without is looked up at any depth,
    through arrays too. Spark has no setter for free-form JSON, so the rewrite runs in a
    pandas UDF; it only receives objects that may contain the searched text.
    """
    if not search:
        raise ValueError("the search text must not be empty")
    path = key.split(".")

    @F.pandas_udf(_RESULT)
    def rewrite(values: pd.Series) -> pd.DataFrame:
        rows = []
        for value in values:
            if value is None:
                rows.append((None, False))
                continue
            node = json.loads(value)
            if len(path) > 1:
                changed = _swap_at_path(node, path, search, replacement)
            else:
                changed = _swap_members(node, key, search, replacement)
            rows.append((_compact(node) if changed else None, changed))
        return pd.DataFrame(rows, columns=["raw", "changed"])

    # Without escapes in the object, its raw text shows the searched text as it is.
    possible = F.contains(raw, F.lit(search)) | F.contains(raw, F.lit("\\"))
    return rewrite(F.when(possible, raw))


def rewrite_objects(objects: DataFrame, key: str, search: str, replacement: str, raw: str = "raw") -> DataFrame:
    """Objects with the replacement applied and a ``changed`` flag; one line of text each."""
    one_line = F.regexp_replace(F.col(raw), r"[\r\n]+[ \t]*", "")
    return (
        objects.withColumn("__new", replace_in_json(F.col(raw), key, search, replacement))
        .withColumn("changed", F.col("__new.changed"))
        .withColumn(raw, F.coalesce(F.col("__new.raw"), one_line))
        .drop("__new")
    )


def set_path(raw: Column, dotted: str, value: str) -> Column:
    """JSON text with the value at a dotted path set to a string; as it was when the path is absent."""
    path = dotted.split(".")

    @F.pandas_udf("string")
    def put(values: pd.Series) -> pd.Series:
        out = []
        for text in values:
            node = None if text is None else json.loads(text)
            holder = _holder(node, path)
            if holder is not None:
                holder[path[-1]] = value
            out.append(text if holder is None else _compact(node))
        return pd.Series(out, dtype=object)

    return put(raw)


def replace_tally(rewritten: DataFrame, group: str = "dataset", grand_total: bool = False) -> DataFrame:
    """Objects and changed objects per file; a file counts as modified with one change or more.

    ``grand_total`` adds a row over all files, under a null name.
    """
    per_file = rewritten.groupBy(group).agg(F.count(F.lit(1)).alias("objects"), F.count_if("changed").alias("changes"))
    grouped = per_file.rollup(group) if grand_total else per_file.groupBy(group)
    return grouped.agg(
        F.sum("objects").alias("objects"),
        F.sum("changes").alias("changes"),
        F.count_if(F.col("changes") > 0).alias("files_modified"),
    )
