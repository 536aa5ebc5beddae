"""Text expressions over Spark columns.

Everything here takes and returns ``Column`` objects built from Spark's own
functions, so it stays inside the JVM and works equally on a plain column or on
the lambda variable of a higher-order function.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The 29 characters Python treats as whitespace.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# The same characters as a pattern: the Unicode property holds all but four of them.
WHITESPACE_RUN = r"(?U)[\s\x1c-\x1f]+"

# Spreadsheet error results that count as empty.
SHEET_ERRORS = ("#DIV/0!", "#VALUE!", "#REF!", "#NAME?", "#NUM!", "#NULL!", "#N/A")

# A column whose name holds one of these keeps its line structure.
LAYOUT_WORDS = ("sample", "code", "snippet", "example", "syntax", "format", "script", "program")

# Fixed value: a plain column whose name holds this is lowercased.
LOWERCASE_WORD = "desc"


def strip(text: Column) -> Column:
    """Strip Unicode whitespace from both ends (Spark's ``trim`` strips spaces only)."""
    return F.btrim(text, F.lit(WHITESPACE))


def squeeze(text: Column) -> Column:
    """Turn every run of whitespace into one space and strip the ends."""
    return F.regexp_replace(strip(text), WHITESPACE_RUN, " ")


def words(text: Column) -> Column:
    return F.split(strip(text), WHITESPACE_RUN)


def word_count(text: Column) -> Column:
    return F.when(strip(text) == "", F.lit(0)).otherwise(F.size(words(text)))


def keeps_layout(header: str | Column):
    """Whether a column keeps line breaks. A plain name is decided on the driver."""
    if isinstance(header, str):
        name = header.lower()
        return any(word in name for word in LAYOUT_WORDS)
    return F.lower(header).rlike("|".join(LAYOUT_WORDS))


def _is_lowercased(header: str | Column):
    if isinstance(header, str):
        return LOWERCASE_WORD in header.lower()
    return F.contains(F.lower(header), F.lit(LOWERCASE_WORD))


def clean_lines(text: Column, keep_indent: bool = False) -> Column:
    """Tidy each line and drop blank ones. ``keep_indent`` keeps leading blanks of a line."""

    def tidy(line: Column) -> Column:
        body = strip(line)
        # The substring tests are far cheaper than the pattern, and most lines need neither.
        ragged = F.contains(body, F.lit("  ")) | F.contains(body, F.lit("\t"))
        body = F.when(ragged, F.regexp_replace(body, "[ \\t]+", " ")).otherwise(body)
        if not keep_indent:
            return body
        return F.when(body == "", body).otherwise(F.concat(F.regexp_extract(line, "^[ \\t]*", 0), body))

    return F.array_join(F.filter(F.transform(F.split(text, "\n"), tidy), lambda line: line != ""), "\n")


def has_content(value: Column) -> Column:
    """Whether ``clean_text`` leaves anything, decided without cleaning."""
    text = strip(F.coalesce(value.cast("string"), F.lit("")))
    return (text != "") & ~F.startswith(text, F.lit("=")) & ~text.isin(*SHEET_ERRORS)


def clean_text(value: Column, header: str | Column, keep_indent: bool = False) -> Column:
    """Clean one cell; null, formulas and error results become the empty string."""
    raw = F.coalesce(value.cast("string"), F.lit(""))
    text = strip(raw)
    layout, lowered = keeps_layout(header), _is_lowercased(header)
    kept = clean_lines(F.rtrim(raw) if keep_indent else text, keep_indent)
    if isinstance(header, str):
        cleaned = kept if layout else squeeze(F.lower(text) if lowered else text)
    else:
        cleaned = F.when(layout, kept).otherwise(squeeze(F.when(lowered, F.lower(text)).otherwise(text)))
    return F.when(F.startswith(text, F.lit("=")) | text.isin(*SHEET_ERRORS), F.lit("")).otherwise(cleaned)


def is_labeled(header: Column, numeric: Column | None = None) -> Column:
    """A header that is neither missing, blank nor an ``Unnamed`` placeholder."""
    name = strip(header)
    labeled = F.coalesce((name != "") & ~F.startswith(F.lower(name), F.lit("unnamed")), F.lit(False))
    return labeled if numeric is None else labeled | (F.coalesce(numeric, F.lit(False)) & header.isNotNull())


def title_case(header: Column) -> Column:
    """``first_name`` -> ``First Name``; the first letter of each word is raised, the rest lowered."""
    return F.initcap(F.array_join(words(F.translate(header, "_-", "  ")), " "))


def normal_header(header: Column, numeric: Column) -> Column:
    """Comparable header name: numbers lose their fraction, text is stripped."""
    return F.when(numeric, header.try_cast("double").try_cast("bigint").cast("string")).otherwise(strip(header))


def snake_key(header: Column) -> Column:
    return F.translate(F.lower(header), " -", "__")


def workbook_id(file_name: Column) -> Column:
    """Workbook name without ``.xlsx`` (any case), then without a trailing ``_references``."""
    stem = F.regexp_replace(file_name, r"(?i)\.xlsx\z", "")
    return F.regexp_replace(stem, r"_references\z", "")


def safe_name(text: Column, limit: int) -> Column:
    """Name usable inside an id: word characters, hyphens and underscores, at most ``limit`` long."""
    kept = F.regexp_replace(text, r"(?U)[^\w\s\p{No}\x1c-\x1f-]", "")
    return F.substring(F.regexp_replace(kept, WHITESPACE_RUN, "_"), 1, limit)


def sheet_name_for_id(text: Column) -> Column:
    return safe_name(text, 50)


def value_for_id(text: Column) -> Column:
    return safe_name(text, 30)


def ellipsis(text: Column, limit: int) -> Column:
    """First ``limit`` characters, followed by ``...`` when something was cut."""
    return F.when(F.length(text) > limit, F.concat(F.substring(text, 1, limit), F.lit("..."))).otherwise(text)


def has_text(haystack: Column, needle: str) -> Column:
    """Case-insensitive literal substring test; a missing value counts as empty text."""
    return F.contains(F.lower(F.coalesce(haystack, F.lit(""))), F.lower(F.lit(needle)))


def file_stem(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*?)(?:\.[^./]*)?\z", 1)


def file_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)\z", 1)


def parent_path(path: Column) -> Column:
    """Everything before the last ``/``; empty for a bare file name."""
    return F.regexp_extract(path, r"^(.*)/[^/]*\z", 1)


def utc_now_text() -> Column:
    return F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
