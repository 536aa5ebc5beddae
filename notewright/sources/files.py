"""Folder listings as DataFrames."""

from __future__ import annotations

from urllib.parse import urlparse

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from notewright.functions.text import file_name, file_stem, parent_path

RECORD_FILES = "{*.jsonl,part-*}"
RECORD_AND_CATALOGUE_FILES = "*.{jsonl,txt}"
# Workbook endings, in any case.
WORKBOOK_FILES = "*.{[xX][lL][sS],[xX][lL][sS][xXmMbB]}"
FLATTENED_FOLDER = "_text"


def decoded_path(uri: Column) -> Column:
    """Readable form of ``_metadata.file_path``, which is percent-encoded."""
    return F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))


def relative_path(path: Column, root: str) -> Column:
    """Path below ``root``; the bare file name when the path lies elsewhere."""
    prefix = urlparse(root).path.rstrip("/") + "/"
    at = F.locate(prefix, path)
    below = F.substr(path, at + F.lit(len(prefix)))
    return F.when(at > 0, below).otherwise(file_name(path))


def dataset_name(below: Column) -> Column:
    """Dataset of a relative path: the value of a ``dataset=`` folder, else the path without its ending."""
    folder = F.regexp_extract(below, r"(?:^|/)dataset=([^/]*)/", 1)
    written = F.url_decode(F.replace(folder, F.lit("+"), F.lit("%2B")))
    return F.when(folder != "", written).otherwise(F.regexp_replace(below, r"\.[^./]*\z", ""))


def written_folder(dataset: str) -> str:
    """Folder that a writer gives a dataset: Spark's partition folder, with its escapes."""
    # The characters Spark escapes in a partition folder.
    special = set("\"#%'*/:=?\\\x7f{[]^") | {chr(code) for code in range(1, 32)}
    return "dataset=" + "".join(f"%{ord(c):02X}" if c in special else c for c in dataset)


def list_files(spark: SparkSession, folder: str, pattern: str = RECORD_FILES, recursive: bool = False) -> DataFrame:
    """``(file_path, relative_path, folder, file_name, stem, size)`` of matching files.

    Only metadata columns are selected, so no file is opened. Names starting with
    ``.`` or ``_`` are skipped by Spark itself; ``~$`` lock files are skipped here.
    """
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", str(recursive).lower())
        .load(folder)
    )
    below = relative_path(F.col("path"), folder)
    return files.select(
        F.col("path").alias("file_path"),
        below.alias("relative_path"),
        parent_path(below).alias("folder"),
        file_name(F.col("path")).alias("file_name"),
        file_stem(F.col("path")).alias("stem"),
        F.col("length").alias("size"),
    ).filter(~F.startswith("file_name", F.lit("~$")))


def require_files(files: DataFrame, folder: str) -> DataFrame:
    """The listing itself, or an error when it is empty."""
    if files.isEmpty():
        raise FileNotFoundError(f"No matching files found in: {folder}")
    return files


def distinct_files(files: DataFrame) -> DataFrame:
    """Each path once, as listings with overlapping patterns may repeat a path."""
    return files.dropDuplicates(["file_path"])


def outside_folder(files: DataFrame, folder: str = FLATTENED_FOLDER) -> DataFrame:
    """Drop files below any folder of this name."""
    return files.filter(~F.contains(F.concat(F.lit("/"), "relative_path"), F.lit(f"/{folder}/")))


def admit_by_size(files: DataFrame, max_mb: float = 100.0) -> DataFrame:
    """Add ``admitted`` and ``reason`` by file size."""
    size_mb = F.col("size") / F.lit(1024 * 1024)
    fits = size_mb <= max_mb
    reason = F.format_string(f"File too large: %.1fMB > {max_mb}MB", size_mb)
    return files.withColumn("admitted", fits).withColumn("reason", F.when(~fits, reason).otherwise(""))


def files_by_folder(files: DataFrame) -> DataFrame:
    """One row per parent folder: ``(folder, n_files, total_size)``. The names are the listing itself."""
    return files.groupBy("folder").agg(
        F.count(F.lit(1)).alias("n_files"), F.sum("size").alias("total_size")
    )
