"""Record files that keep arriving: the same parsing as the batch reader, file by file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from notewright.functions.jsontext import is_json_object
from notewright.functions.text import strip
from notewright.sources.files import RECORD_FILES, dataset_name, decoded_path, relative_path
from notewright.sources.jsonl import parse_records


def stream_records(
    spark: SparkSession, folder: str, pattern: str = RECORD_FILES, pretty: bool = False, max_files: int = 1000
) -> DataFrame:
    """Streaming records of new files in a folder; bad lines are left out."""
    reader = spark.readStream.format("text").option("pathGlobFilter", pattern).option("maxFilesPerTrigger", max_files)
    if pretty:
        reader = reader.option("lineSep", "\n}\n")
    lines = reader.load(folder).select(decoded_path(F.col("_metadata.file_path")).alias("file_path"), "value")
    if pretty:
        open_end = (strip(F.col("value")) != "") & ~F.endswith("value", F.lit("\n}"))
        lines = lines.withColumn("value", F.when(open_end, F.concat("value", F.lit("\n}"))).otherwise(F.col("value")))
    dataset = dataset_name(relative_path(F.col("file_path"), folder))
    objects = lines.filter(is_json_object(F.col("value"))).select(
        dataset.alias("dataset"), "file_path", F.col("value").alias("raw")
    )
    return parse_records(objects)


def append_records(records: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Append the records seen so far to a Parquet table and stop."""
    return (
        records.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
