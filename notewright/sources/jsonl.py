"""Record files: one object per line, pretty-printed, or strung together."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from notewright.functions.jsontext import is_json_object, is_json_value, last_wins_map
from notewright.functions.text import strip
from notewright.operators.sizing import is_small, join_measured
from notewright.sources.files import RECORD_FILES, dataset_name, decoded_path, relative_path
from notewright.sources.objects import ACCUMULATE, TOLERANT, find_objects

METADATA = (
    "struct<file_name string, file_path string, sheet_name string, row_index int, total_labeled_columns int, "
    "non_empty_columns int, columns_used array<string>, text_length int, word_count int, processing_timestamp string>"
)
RECORD = f"struct<id string, sheet string, text map<string,string>, metadata {METADATA}, columns map<string,string>>"
_KNOWN = ("id", "sheet", "text", "metadata", "columns")
_METADATA_NAMES = [part.split()[0] for part in METADATA.removeprefix("struct<").split(", ")]

MODES = ("prefix", "lines", "pretty", ACCUMULATE, TOLERANT, "auto")


def _fix_splits(spark: SparkSession) -> None:
    """Make Spark cut the same files the same way for the rest of the session.

    The size of a split follows the number of cores when it is not set otherwise, and that
    number changes while executors come and go. Orders and split states found by one job are
    used by the next, so it is set once, where the session leaves it open.
    """
    name = "spark.sql.files.minPartitionNum"
    if spark.conf.get(name, None) is None:
        # Orders need splits of 4 KiB at least, which the cost of opening a file assures by default.
        open_cost = _bytes(spark.conf.get("spark.sql.files.openCostInBytes"))
        spark.conf.set(name, str(max(200, spark.sparkContext.defaultParallelism) if open_cost >= 4096 else 1))


def _text_rows(
    spark: SparkSession, path: str, pattern: str, line_sep: str | None = None, above_bytes: int = 0
) -> DataFrame:
    _fix_splits(spark)
    reader = spark.read.format("text").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern)
    if line_sep:
        reader = reader.option("lineSep", line_sep)
    rows, meta = reader.load(path), F.col("_metadata")
    if above_bytes:
        rows = rows.filter(meta["file_size"] > above_bytes)  # decided per file, before any is opened
    return rows.select(
        decoded_path(meta["file_path"]).alias("file_path"),
        meta["file_block_start"].alias("block"),
        (meta["file_block_length"] < meta["file_size"]).alias("partial"),
        F.monotonically_increasing_id().alias("place"),
        "value",
    )


def _bytes(setting: str) -> int:
    """Bytes of a setting such as ``128m`` or ``134217728b``."""
    number, unit = re.fullmatch(r"(\d+)([kmgt]?)b?", setting.strip().lower()).groups()
    return int(number) << {"": 0, "k": 10, "m": 20, "g": 30, "t": 40}[unit]


def _never_split_bytes(spark: SparkSession) -> int:
    """Size up to which Spark never cuts a file."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    return min(_bytes(spark.conf.get(name)) for name in names)


def _order_key(block: Column, place: Column) -> Column:
    """File order without counting rows: split start (in 4 KiB steps), then row of the task."""
    return F.shiftleft(F.shiftright(block, 12), 31).bitwiseOR(place.bitwiseAND(F.lit((1 << 31) - 1)))


def scan_lines(spark: SparkSession, path: str, pattern: str = RECORD_FILES, line_sep: str | None = None) -> DataFrame:
    """``(file_path, ord, value)`` for every line; ``ord`` is unique and rising inside a file."""
    rows = _text_rows(spark, path, pattern, line_sep)
    return rows.select("file_path", _order_key(F.col("block"), F.col("place")).alias("ord"), "value")


def _braced(spark: SparkSession, path: str, pattern: str, mode: str, only: DataFrame | None = None) -> DataFrame:
    def lines(above_bytes: int) -> DataFrame:
        text = _text_rows(spark, path, pattern, above_bytes=above_bytes)
        text = text.withColumn("value", F.col("value").cast("binary"))
        if only is None:
            return text
        files = only.select("file_path")
        text = join_measured(text, files, "file_path", "left_semi")
        if is_small(files):
            return text
        # The other join moves lines, and the matcher needs them in order.
        return text.sortWithinPartitions("file_path", "block", "place")

    found = find_objects(lines(0), lines(_never_split_bytes(spark)), mode)
    return found.withColumn("raw", strip(F.col("raw"))).filter(is_json_object(F.col("raw")))


def _line_status(lines: DataFrame) -> DataFrame:
    """Per file with a bad line: order of its first line and of its first bad line."""
    return (
        lines.filter("value != ''")
        .groupBy("file_path")
        .agg(
            F.min("ord").alias("first_line"),
            F.min(F.when(~is_json_value(F.col("value")), F.col("ord"))).alias("first_bad"),
        )
        .filter("first_bad is not null")
    )


def scan_objects(
    spark: SparkSession,
    path: str,
    mode: str = "auto",
    pattern: str = RECORD_FILES,
    newline: str = "\n",
) -> DataFrame:
    """``(dataset, file_path, ord, raw)``: every JSON object of the matching files, as text.

    ``lines`` keeps all valid lines. ``prefix`` stops at the first bad line of a file and
    brace-matches files that start with one. ``pretty`` reads two-space indented files
    without Python and in parallel. ``accumulate`` and ``tolerant`` match braces; the
    first loses an object that follows junk. ``auto`` takes ``lines`` for files whose first
    line parses and ``tolerant`` for the others, at the price of one extra pass.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, got {mode!r}")
    if mode in (ACCUMULATE, TOLERANT):
        found = _braced(spark, path, pattern, mode)
    elif mode == "pretty":
        pieces = scan_lines(spark, path, pattern, f"\n}}{newline}").filter(strip(F.col("value")) != "")
        closed = F.when(F.endswith("value", F.lit("\n}")), F.col("value")).otherwise(F.concat("value", F.lit("\n}")))
        found = pieces.select("file_path", "ord", closed.alias("raw")).filter(is_json_object(F.col("raw")))
    else:
        lines = scan_lines(spark, path, pattern).withColumn("value", strip(F.col("value")))
        objects = lines.filter(is_json_object(F.col("value"))).withColumnRenamed("value", "raw")
        if mode == "lines":
            found = objects
        else:
            status = _line_status(lines).persist()
            bad_start = status.filter("first_bad = first_line")
            found = join_measured(objects, status, "file_path", "left")
            keep = "first_bad is null or " + ("ord < first_bad" if mode == "prefix" else "first_bad > first_line")
            found = found.filter(keep).select("file_path", "ord", "raw")
            if not bad_start.isEmpty():
                braced = _braced(spark, path, pattern, ACCUMULATE if mode == "prefix" else TOLERANT, bad_start)
                found = found.unionByName(braced)
    dataset = dataset_name(relative_path(F.col("file_path"), path))
    return found.select(dataset.alias("dataset"), "file_path", "ord", "raw")


def scan_rejects(spark: SparkSession, path: str, pattern: str = RECORD_FILES) -> DataFrame:
    """``(file_path, ord, value)`` of the non-blank lines that are not one JSON object."""
    lines = scan_lines(spark, path, pattern).withColumn("value", strip(F.col("value"))).filter("value != ''")
    return lines.filter(~is_json_object(F.col("value")))


def other_lines(spark: SparkSession, path: str, mode: str = "auto", pattern: str = RECORD_FILES) -> DataFrame:
    """``(dataset, file_path, ord, raw)`` of the lines that ``scan_objects`` passes over in files it reads line by line."""
    rejects = scan_rejects(spark, path, pattern)
    if mode == "auto":
        lines = scan_lines(spark, path, pattern).withColumn("value", strip(F.col("value")))
        status = _line_status(lines).select("file_path", (F.col("first_bad") > F.col("first_line")).alias("by_line"))
        rejects = join_measured(rejects, status, "file_path", "left").filter("coalesce(by_line, true)")
    dataset = dataset_name(relative_path(F.col("file_path"), path))
    return rejects.select(dataset.alias("dataset"), "file_path", "ord", F.col("value").alias("raw"))


def _has(name: str) -> Column:
    return F.coalesce(F.array_contains("keys", name), F.lit(False))


def parse_records(objects: DataFrame, raw: str = "raw") -> DataFrame:
    """Records from JSON text: adds ``id, sheet, text, metadata, columns, other`` and key-presence flags.

    ``text`` is null when it is missing or not an object. Repeated keys keep the last value.
    ``other`` holds whatever else the record has: further keys of its own under their names, and
    further keys of its metadata as ``metadata.name``; values that are no strings as JSON text.
    """
    record = F.from_json(raw, RECORD)
    own = last_wins_map(F.map_entries(F.from_json(raw, "map<string,string>")))
    own = F.map_filter(own, lambda key, _: ~key.isin(*_KNOWN))
    inner = F.from_json(raw, "struct<metadata: map<string,string>>")["metadata"]
    inner = F.map_filter(last_wins_map(F.map_entries(inner)), lambda key, _: ~key.isin(*_METADATA_NAMES))
    nothing = F.create_map().cast("map<string,string>")
    named = F.transform_keys(inner, lambda key, _: F.concat(F.lit("metadata."), key))
    other = F.map_concat(F.coalesce(F.map_filter(own, lambda key, _: ~F.startswith(key, F.lit("metadata."))), nothing), F.coalesce(named, nothing))
    text = F.col("record.text")
    return (
        objects.withColumn("record", record)
        .withColumn("keys", F.json_object_keys(raw))
        .withColumn("text", F.when(text.isNotNull(), last_wins_map(F.map_entries(text))))
        .select(
            *objects.columns,
            F.col("record.id").alias("id"),
            F.col("record.sheet").alias("sheet"),
            "text",
            F.col("record.metadata").alias("metadata"),
            F.when(F.col("record.columns").isNotNull(), last_wins_map(F.map_entries("record.columns"))).alias("columns"),
            other.alias("other"),
            _has("id").alias("has_id"),
            _has("sheet").alias("has_sheet"),
            _has("text").alias("has_text"),
        )
    )


def read_records(
    spark: SparkSession, path: str, mode: str = "auto", pattern: str = RECORD_FILES, newline: str = "\n"
) -> DataFrame:
    """Record files as records."""
    return parse_records(scan_objects(spark, path, mode, pattern, newline))
