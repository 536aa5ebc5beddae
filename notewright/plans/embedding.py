"""Record files to an embedding set."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from notewright.operators.encoders import BATCH_SIZE, DIMENSION, MODEL_NAME, Encoder
from notewright.operators.numbering import number_files
from notewright.operators.records import valid_for_embedding
from notewright.operators.vectors import embed, embedding_metadata, embedding_text_of_json
from notewright.session import stored
from notewright.sinks.vectors import write_embeddings
from notewright.sources.files import relative_path
from notewright.sources.jsonl import read_records


def numbered_texts(spark: SparkSession, folder: str, mode: str = "auto") -> DataFrame:
    """Metadata rows of all documents below a folder that have a text to embed.

    The parsed documents are stored once; numbering then reads two narrow columns of them
    to count and all of them to number.
    """
    records = valid_for_embedding(read_records(spark, folder, mode))
    documents = records.withColumn("embedding_text", embedding_text_of_json(F.col("raw"))).withColumn(
        "source_file", relative_path(F.col("file_path"), folder)
    )
    documents = stored(documents.select("source_file", "ord", "id", "sheet", "metadata", "embedding_text"), "documents")
    numbered = number_files(documents, "source_file", "ord", F.col("embedding_text") != "")
    return embedding_metadata(numbered, F.col("source_file"), "embedding_text")


def embed_folder(
    spark: SparkSession,
    folder: str,
    out: str,
    encoder: Encoder,
    model_name: str = MODEL_NAME,
    dimension: int = DIMENSION,
    batch_size: int = BATCH_SIZE,
    mode: str = "auto",
) -> None:
    """Embed every document below a folder and write the embedding set."""
    rows = numbered_texts(spark, folder, mode).withColumn("embedding", embed(encoder, "text", batch_size))
    write_embeddings(rows, out, model_name, dimension, folder.rstrip("/").rpartition("/")[2])
