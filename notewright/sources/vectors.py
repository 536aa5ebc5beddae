"""Stored embedding sets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_embeddings(spark: SparkSession, path: str) -> DataFrame:
    """Embedding set: vector and metadata in one row per document."""
    return spark.read.parquet(f"{path}/vectors")


def read_collection(spark: SparkSession, path: str) -> DataFrame:
    """Vector collection: ``(id, embedding, text)``."""
    return spark.read.parquet(path)


def join_vectors(metadata: DataFrame, vectors: DataFrame) -> DataFrame:
    """Metadata and vectors kept apart, joined on their common ``global_index``."""
    return metadata.join(vectors, "global_index")
