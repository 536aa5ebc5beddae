"""DuckDB counterparts of the text expressions, for the SQL side of the queries."""

from __future__ import annotations

from notewright.functions.text import SHEET_ERRORS

# Unicode whitespace spelled out, as DuckDB's ``\\s`` is ASCII only.
WHITESPACE_CLASS = (
    r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)


def strip_sql(x: str) -> str:
    return f"regexp_replace({x}, '^{WHITESPACE_CLASS}+|{WHITESPACE_CLASS}+$', '', 'g')"


def _guarded(x: str, cleaned: str) -> str:
    errors = ", ".join(f"'{e}'" for e in SHEET_ERRORS)
    return f"CASE WHEN starts_with({strip_sql(x)}, '=') OR {strip_sql(x)} IN ({errors}) THEN '' ELSE {cleaned} END"


def plain_sql(x: str, lowered: bool = False) -> str:
    """Cleaning of a column that does not keep its lines."""
    x = f"coalesce({x}, '')"
    base = strip_sql(x)
    base = f"lower({base})" if lowered else base
    squeezed = f"regexp_replace({base}, '{WHITESPACE_CLASS}+', ' ', 'g')"
    return _guarded(x, strip_sql(squeezed))


def lines_sql(x: str) -> str:
    """Cleaning of a column that keeps its lines."""
    x = f"coalesce({x}, '')"
    tidy = f"regexp_replace({strip_sql('l')}, '[ \\t]+', ' ', 'g')"
    kept = f"list_filter(list_transform(string_split({strip_sql(x)}, chr(10)), lambda l: {tidy}), lambda l: l <> '')"
    return _guarded(x, f"array_to_string({kept}, chr(10))")


def words_sql(x: str) -> str:
    """Number of words."""
    return f"len(list_filter(regexp_split_to_array({x}, '{WHITESPACE_CLASS}+'), lambda w: w <> ''))"
