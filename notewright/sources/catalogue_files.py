"""Field catalogue sidecars: ``<stem>_texted.txt`` next to a record file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from notewright.sources.files import dataset_name, decoded_path, relative_path

SIDECAR_SUFFIX = "_texted.txt"
_CONTENT = "struct<text: struct<text_fields: array<string>>>"


def read_catalogues(spark: SparkSession, path: str) -> DataFrame:
    """``(dataset, text_fields)`` of sidecars, both as single files and as written by ``write_catalogues``.

    A sidecar without the field list gives an empty array.
    """
    rows = (
        spark.read.format("text")
        .option("wholetext", "true")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.txt")
        .load(path)
        .select(relative_path(decoded_path(F.col("_metadata.file_path")), path).alias("below"), "value")
    )
    single = F.regexp_extract("below", r"^(.*)_texted\.txt\z", 1)
    fields = F.from_json("value", _CONTENT)["text"]["text_fields"]
    return (
        rows.withColumn("dataset", F.when(single != "", single).otherwise(dataset_name(F.col("below"))))
        .filter((single != "") | F.col("below").rlike("(^|/)dataset="))
        .select("dataset", F.coalesce(fields, F.array().cast("array<string>")).alias("text_fields"))
    )


def catalogue_fields(catalogues: DataFrame, dataset: str) -> list[str]:
    """Field names of one dataset; a missing sidecar is an error."""
    found = catalogues.filter(F.col("dataset") == dataset).select("text_fields").first()
    if found is None:
        raise FileNotFoundError(f"Schema file not found: {dataset}{SIDECAR_SUFFIX}")
    return list(found["text_fields"])
