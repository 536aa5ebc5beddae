"""Nested JSON payloads: an object whose ``data`` array holds cards with their sets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CARDS = "data array<struct<id:bigint,card_sets:array<struct<set_code:string>>>>"


def read_cards(spark: SparkSession, path: str) -> DataFrame:
    """``(id, card_sets)`` per card of the payload files."""
    payload = spark.read.schema(CARDS).option("multiLine", "true").json(path)
    return payload.select(F.explode("data").alias("card")).select("card.*")


def flatten_sets(cards: DataFrame) -> DataFrame:
    """``(id, set_code)`` per set; cards without sets vanish and repeats stay."""
    return cards.select("id", F.explode("card_sets").alias("set")).select("id", F.col("set.set_code").alias("set_code"))
