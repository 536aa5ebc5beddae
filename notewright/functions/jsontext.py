"""Expressions over JSON held as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_MARK = "\u241e"


def is_json_value(text: Column) -> Column:
    """Whether the text is exactly one JSON value.

    Spark's JSON functions accept trailing junk, so the text is placed as the
    first element of an array whose second element is a marker: the marker is
    only reachable when the text is one complete value. Single-quoted strings and
    control characters inside strings, which Spark also accepts, are refused.
    """
    probe = F.concat(F.lit("["), text, F.lit(f',"{_MARK}"]'))
    complete = F.coalesce(F.get_json_object(probe, "$[1]") == _MARK, F.lit(False))
    well_formed_string = r'"[^"\\\x00-\x1f]*+(?:\\[^\x00-\x1f][^"\\\x00-\x1f]*+)*+"'
    # Quotes that are left over belong to single-quoted strings or to raw control characters.
    outside_strings = F.regexp_replace(text, well_formed_string, "")
    quoted_well = F.when(text.rlike(r"['\x00-\x1f]"), ~outside_strings.rlike("['\"]")).otherwise(F.lit(True))
    return F.coalesce(complete & quoted_well, F.lit(False))


def is_json_object(text: Column) -> Column:
    """Whether the text is exactly one JSON object."""
    return F.coalesce(text.rlike(r"^\s*\{"), F.lit(False)) & is_json_value(text)


def last_wins_map(entries: Column, key: str = "key", value: str = "value") -> Column:
    """Map from an array of entries where a repeated key keeps its first place and last value."""
    keys = F.transform(entries, lambda e: e[key])
    unique = F.array_distinct(keys)
    plain = F.map_from_arrays(keys, F.transform(entries, lambda e: e[value]))
    folded = F.map_from_arrays(
        unique,
        F.transform(unique, lambda k: F.element_at(F.filter(entries, lambda e: e[key] == k), -1)[value]),
    )
    return F.when(F.size(keys) == F.size(unique), plain).otherwise(folded)


def text_map(json_text: Column) -> Column:
    """Parse an object to ``map<string,string>`` in key order; nested values stay JSON text."""
    return F.from_json(json_text, "map<string,string>")


def path_literal(dotted: str) -> str:
    """``a.b`` -> ``$['a']['b']``"""
    return "$" + "".join(f"['{part}']" for part in dotted.split("."))


def get_path(json_text: Column, dotted: str) -> Column:
    """Value at a dotted path, null when absent. Strings come back unquoted, nested values as JSON."""
    return F.get_json_object(json_text, path_literal(dotted))


def last_at_path(json_text: Column, dotted: str) -> Column:
    """As ``get_path``, but a repeated key gives its last value instead of its first."""
    names = dotted.split(".")
    kind: T.DataType = T.StringType()
    for name in reversed(names):
        kind = T.StructType([T.StructField(name, kind)])
    value = F.from_json(json_text, kind)
    for name in names:
        value = value.getField(name)
    return value


def has_key(json_text: Column, name: str) -> Column:
    """Key presence, which tells a JSON null from a missing key."""
    return F.coalesce(F.array_contains(F.json_object_keys(json_text), name), F.lit(False))
