"""Embedding texts, embeddings and nearest neighbours by cosine."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from notewright.functions.jsontext import last_wins_map
from notewright.functions.text import parent_path
from notewright.operators.encoders import BATCH_SIZE, Encoder
from notewright.operators.sizing import join_measured

QUERY_BLOCK = 16_384
_SCORES_AT_ONCE = 4_000_000


def embedding_text(text: str | Column = "text") -> Column:
    """``Key: value`` of every non-empty value, joined by `` | `` in key order."""
    filled = F.filter(F.map_entries(text), lambda e: e["value"].isNotNull() & (e["value"] != ""))
    parts = F.transform(filled, lambda e: F.concat(e["key"], F.lit(": "), e["value"]))
    return F.coalesce(F.array_join(parts, " | "), F.lit(""))


def _python_text(value: Column) -> Column:
    """Text of a typed JSON value, null for the values that count as empty."""
    kind, text = F.schema_of_variant(value), F.expr("cast(null as string)")
    plain = value.cast("string")
    number = kind.rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL)")
    return (
        F.when(kind == "VOID", text)
        .when(kind == "BOOLEAN", F.when(plain == "true", F.lit("True")))
        .when(number, F.when(plain.cast("double") != 0, plain))
        .when(kind.rlike("^(ARRAY|OBJECT)"), F.when(~plain.isin("[]", "{}"), plain))
        .otherwise(F.nullif(plain, F.lit("")))
    )


def embedding_text_of_json(raw: Column) -> Column:
    """Embedding text straight from a JSON record, where values may be other than strings.

    Zero, false, empty containers and nulls are left out; a ``text`` that is no object
    stands for itself.
    """
    text = F.from_json(raw, "struct<text: string>")["text"]
    typed = F.from_json(raw, "struct<text: variant>")["text"]
    members = F.from_json(text, "map<string,variant>")
    # The variant parser refuses a repeated key; such a text can only be an object.
    is_object = F.coalesce(F.startswith(F.schema_of_variant(typed), F.lit("OBJECT")), members.isNotNull())
    values = F.transform(
        F.map_entries(last_wins_map(F.map_entries(members))),
        lambda e: F.struct(e["key"].alias("key"), _python_text(e["value"]).alias("value")),
    )
    parts = F.transform(
        F.filter(values, lambda e: e["value"].isNotNull()), lambda e: F.concat(e["key"], F.lit(": "), e["value"])
    )
    return F.coalesce(F.when(is_object, F.array_join(parts, " | ")).otherwise(_python_text(typed)), F.lit(""))


def embedding_metadata(numbered: DataFrame, source_file: Column, text: str) -> DataFrame:
    """Metadata rows of an embedding set, with defaults for what a record lacks."""
    return numbered.select(
        "global_index",
        source_file.alias("source_file"),
        "local_index",
        F.coalesce("id", F.lit("")).alias("original_id"),
        F.coalesce("sheet", F.lit("")).alias("sheet"),
        F.coalesce("metadata.file_name", F.lit("")).alias("file_name"),
        F.coalesce("metadata.row_index", F.lit(-1)).alias("row_index"),
        F.col(text).alias("text"),
    )


def embed(encoder: Encoder, text: str | Column, batch_size: int = BATCH_SIZE) -> Column:
    """Vector of a text column; the encoder is built once per task and fed in batches."""

    @F.pandas_udf("array<float>")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = encoder()
        for texts in batches:
            matrix = np.asarray(model.encode(texts.fillna("").tolist(), batch_size=batch_size), dtype=np.float32)
            yield pd.Series(list(matrix))

    return encode(text)


def cosine_similarity(a: Column, b: Column) -> Column:
    """Cosine of two vectors in double precision, 0 when one of them is all zeros."""

    def dot(x: Column, y: Column) -> Column:
        products = F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double"))
        return F.aggregate(products, F.lit(0.0), lambda total, p: total + p)

    lengths = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(lengths == 0, F.lit(0.0)).otherwise(dot(a, b) / lengths)


def _best(k: int, query_ids: Sequence, queries: np.ndarray):
    """Best ``k`` corpus rows per query among the rows of one task."""
    lengths = np.linalg.norm(queries, axis=1, keepdims=True)
    unit = queries / np.where(lengths == 0, 1.0, lengths)

    def candidates(ids: np.ndarray, vectors: np.ndarray) -> Iterator[tuple]:
        """``(query, id, score)`` arrays that hold the best ``k`` of one batch, ties included."""
        norms = np.linalg.norm(vectors, axis=1)
        norms = np.where(norms == 0, 1.0, norms)
        step = max(1, _SCORES_AT_ONCE // len(ids))
        for start in range(0, len(unit), step):
            scores = (unit[start : start + step] @ vectors.T) / norms
            if len(ids) > k:
                least = np.partition(scores, len(ids) - k, axis=1)[:, len(ids) - k, None]
                query, at = np.nonzero(scores >= least)
            else:
                query, at = np.nonzero(np.ones_like(scores, dtype=bool))
            yield query + start, ids[at], scores[query, at]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = (np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0))
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            flat = batch.column(1).flatten().to_numpy(zero_copy_only=False)
            vectors = flat.astype(np.float64).reshape(len(ids), unit.shape[1])
            query, id_, score = (np.concatenate(parts) for parts in zip(best, *candidates(ids, vectors)))
            order = np.lexsort((id_, -score, query))
            query, id_, score = query[order], id_[order], score[order]
            keep = np.arange(len(query)) - np.searchsorted(query, query) < k
            best = (query[keep], id_[keep], score[keep])
        query, id_, score = best
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.asarray(query_ids, dtype=np.int64)[query]), pa.array(id_), pa.array(score)],
            names=["query_id", "id", "score"],
        )

    return run


def _top(pairs: DataFrame, k: int) -> DataFrame:
    """Best ``k`` per query with their rank; Spark cuts each task to ``k`` rows before the shuffle."""
    best_first = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return pairs.withColumn("rank", F.row_number().over(best_first)).filter(F.col("rank") <= k)


def nearest(
    corpus: DataFrame, query: Sequence[float], k: int = 3, id: str = "vec_id", embedding: str = "embedding"
) -> DataFrame:
    """``(id, score, rank)``: the ``k`` corpus rows nearest to one vector by cosine, ids breaking ties.

    One pass over ``id`` and ``embedding``; each task returns ``k`` rows.
    """
    vector = np.asarray([query], dtype=np.float64)
    pairs = corpus.select(F.col(id).cast("bigint"), embedding).mapInArrow(
        _best(k, [0], vector), "query_id bigint, id bigint, score double"
    )
    return _top(pairs, k).select("id", "score", "rank")


def nearest_batch(
    corpus: DataFrame,
    queries: DataFrame,
    k: int = 3,
    query_id: str = "query_id",
    query_vector: str = "embedding",
    id: str = "vec_id",
    embedding: str = "embedding",
    block: int = QUERY_BLOCK,
) -> DataFrame:
    """``(query_id, id, score, rank)`` for a table of query vectors.

    Exact search has to score every pair, but no pair leaves its task: a block of at most
    about ``block`` query vectors travels with the code and is multiplied with each batch
    of the corpus. More queries than one block holds cost one pass over the corpus each.
    """
    queries = queries.select(F.col(query_id).cast("bigint").alias("query_id"), F.col(query_vector).alias("vector")).persist()
    blocks = -(-queries.count() // block)
    corpus = corpus.select(F.col(id).cast("bigint"), embedding)
    found: DataFrame | None = None
    for number in range(blocks):
        rows = queries.filter(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == number).collect()
        if not rows:
            continue
        matrix = np.asarray([row["vector"] for row in rows], dtype=np.float64)
        part = _best(k, [row["query_id"] for row in rows], matrix)
        pairs = corpus.mapInArrow(part, "query_id bigint, id bigint, score double")
        found = pairs if found is None else found.unionByName(pairs)
    if found is None:
        return corpus.sparkSession.createDataFrame([], "query_id bigint, id bigint, score double, rank int")
    return _top(found, k)


def with_payload(hits: DataFrame, corpus: DataFrame, id: str = "vec_id", payload: Sequence[str] = ("text",)) -> DataFrame:
    """Hits with further columns of the corpus; few hits travel to the corpus, many are joined by id."""
    rows = corpus.select(F.col(id).cast("bigint").alias("id"), *payload)
    return join_measured(rows, hits, "id", skewed=False)


def hit_display(hits: DataFrame, text: str = "text") -> DataFrame:
    """Hits as shown to a reader: score with three decimals, first 80 characters."""
    return hits.withColumn("score", F.round("score", 3)).withColumn(text, F.substring(text, 1, 80))


def run_info(metadata: DataFrame, model_name: str, dimension: int, source_folder: str) -> DataFrame:
    """One row about an embedding set: model, dimension, vectors, source files and sub-folders."""
    files = metadata.groupBy("source_file").agg(F.count(F.lit(1)).alias("n"))
    folder = F.nullif(parent_path(F.col("source_file")), F.lit(""))
    return files.agg(
        F.lit(model_name).alias("model_name"),
        F.lit(dimension).alias("embedding_dimension"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("num_embeddings"),
        F.lit(source_folder).alias("source_folder"),
        F.count(F.lit(1)).alias("num_source_files"),
        F.count_distinct(folder).alias("num_subfolders_processed"),
    )


def subfolders(metadata: DataFrame) -> DataFrame:
    """Sorted distinct sub-folders of the source files, one per row."""
    folder = parent_path(F.col("source_file"))
    return metadata.select(folder.alias("folder")).filter("folder != ''").distinct().orderBy("folder")
