"""Embedding sets and vector collections."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from notewright.functions.text import utc_now_text
from notewright.operators.vectors import run_info, subfolders
from notewright.sources.vectors import read_embeddings


def write_embeddings(
    embedded: DataFrame, path: str, model_name: str, dimension: int, source_folder: str, mode: str = "errorifexists"
) -> None:
    """Vectors with metadata, run information and the list of sub-folders, side by side below ``path``.

    The information is taken from the written vectors, so documents are encoded once.
    """
    embedded.write.mode(mode).parquet(f"{path}/vectors")
    stored = read_embeddings(embedded.sparkSession, path)
    info = run_info(stored, model_name, dimension, source_folder).withColumn("created_at", utc_now_text())
    info.coalesce(1).write.mode(mode).json(f"{path}/info")
    subfolders(stored).write.mode(mode).json(f"{path}/subfolders")


def write_collection(
    embedded: DataFrame,
    path: str,
    dimension: int,
    id: str = "global_index",
    embedding: str = "embedding",
    text: str = "text",
    text_limit: int | None = None,
) -> None:
    """Replace a vector collection by ``(id, embedding, text)``; a vector of another length is an error.

    Texts are whole unless ``text_limit`` gives the characters to keep.
    """
    size = F.size(embedding)
    complaint = F.concat(F.lit(f"vector length is not {dimension}: "), size.cast("string"))
    checked = F.when(size == dimension, F.col(embedding)).otherwise(F.raise_error(complaint).cast("array<float>"))
    embedded.select(
        F.col(id).cast("bigint").alias("id"),
        checked.alias("embedding"),
        (F.col(text) if text_limit is None else F.substring(text, 1, text_limit)).alias("text"),
    ).write.mode("overwrite").parquet(path)
