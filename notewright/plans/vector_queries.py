"""Embedding texts, numbering, vectors and neighbours."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from notewright.operators.ann import build_index, search_batch, search_index
from notewright.operators.encoders import hashing_encoder
from notewright.operators.numbering import number_files
from notewright.operators.vectors import (
    cosine_similarity,
    embed,
    embedding_metadata,
    embedding_text,
    embedding_text_of_json,
    hit_display,
    nearest,
    nearest_batch,
    run_info,
    subfolders,
    with_payload,
)
from notewright.operators.search import first_per_id
from notewright.operators.sizing import join_measured
from notewright.plans.embedding import embed_folder
from notewright.plans.registry import query, table
from notewright.plans.search_queries import part_records
from notewright.session import scratch_path
from notewright.sinks.records import write_compact
from notewright.sinks.vectors import write_collection, write_embeddings
from notewright.sources.vectors import join_vectors, read_collection, read_embeddings

_COSINE = "list_cosine_similarity(e.embedding::DOUBLE[], q.embedding::DOUBLE[])"


@query(
    """SELECT p_partkey AS ord, 'Name: ' || p_name || ' | Brand: ' || p_brand || ' | Type: ' || p_type || ' | Size: ' || p_size AS text
       FROM part"""
)
def embed_text(spark, sf_dir):
    return part_records(spark, sf_dir).select("ord", embedding_text().alias("text"))


@query(
    """SELECT p_partkey AS ord, CASE WHEN p_size % 2 = 0 THEN 'Name: ' || p_name || ' | ' ELSE '' END || 'Size: ' || p_size ||
              CASE WHEN p_size % 3 = 0 THEN ' | Flag: True' ELSE '' END AS text
       FROM part"""
)
def embed_text_typed(spark, sf_dir):
    name = F.when(F.col("p_size") % 2 == 0, F.col("p_name")).otherwise(F.lit(""))
    flag = F.when(F.col("p_size") % 3 == 0, F.lit("true")).otherwise(F.lit("false"))
    raw = F.concat(
        F.lit('{"text":{"Zero":0,"Name":"'), name, F.lit('","Size":'), F.col("p_size").cast("string"),
        F.lit(',"None":null,"Empty":[],"Flag":'), flag, F.lit("}}"),
    )
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("ord"), embedding_text_of_json(raw).alias("text"))


def _numbered_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    return number_files(turns, "conv_id", "turn", F.col("role") != "system", chunk_bits=2)


_NUMBERED_SQL = """SELECT conv_id, turn, role, text, local_index, row_number() OVER (ORDER BY conv_id, turn) - 1 AS global_index FROM
    (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS local_index FROM conversations)
    WHERE role <> 'system'"""


@query(f"SELECT conv_id, turn, local_index, global_index FROM ({_NUMBERED_SQL})")
def global_local_index(spark, sf_dir):
    return _numbered_turns(spark, sf_dir).select("conv_id", "turn", "local_index", "global_index")


def _metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embedding metadata of the conversation turns; one file per conversation, one folder per ten."""
    folder = F.concat(F.lit("g"), F.floor(F.col("conv_id") / 10).cast("string"), F.lit("/c"), F.col("conv_id").cast("string"))
    file_name = F.when(F.col("turn") % 2 == 0, F.col("role"))
    turns = (
        _numbered_turns(spark, sf_dir)
        .withColumn("id", F.col("conv_id").cast("string"))
        .withColumn("sheet", F.col("role"))
        .withColumn("metadata", F.struct(file_name.alias("file_name"), F.lit(None).cast("int").alias("row_index")))
    )
    return embedding_metadata(turns, folder, "text")


@query(
    f"""SELECT global_index, 'g' || (conv_id // 10) || '/c' || conv_id AS source_file, local_index, CAST(conv_id AS VARCHAR) AS original_id,
               role AS sheet, CASE WHEN turn % 2 = 0 THEN role ELSE '' END AS file_name, -1 AS row_index, md5(text) AS text
        FROM ({_NUMBERED_SQL})"""
)
def embedding_rows(spark, sf_dir):
    return _metadata(spark, sf_dir).withColumn("text", F.md5("text"))


@query(
    """SELECT count(*) AS num_embeddings, count(DISTINCT conv_id) AS num_source_files,
              count(DISTINCT conv_id // 10) AS num_subfolders_processed FROM conversations WHERE role <> 'system'"""
)
def embedding_run_info(spark, sf_dir):
    info = run_info(_metadata(spark, sf_dir), "hashing", 64, "conversations")
    return info.select("num_embeddings", "num_source_files", "num_subfolders_processed")


@query("SELECT DISTINCT 'g' || (conv_id // 10) AS folder FROM conversations WHERE role <> 'system'")
def embedding_subfolders(spark, sf_dir):
    return subfolders(_metadata(spark, sf_dir))


@query(
    f"""SELECT e.vec_id AS id, round({_COSINE}, 6) AS score FROM embeddings e,
        (SELECT embedding FROM embeddings ORDER BY vec_id LIMIT 1) q ORDER BY {_COSINE} DESC, e.vec_id LIMIT 3"""
)
def knn_exact(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    first = vectors.orderBy("vec_id").select("embedding").first()["embedding"]
    return nearest(vectors, first, 3).select("id", F.round("score", 6).alias("score"))


@query(
    f"""SELECT query_id, id, round(score, 6) AS score, rank FROM
          (SELECT q.query_id, e.vec_id AS id, {_COSINE} AS score,
                  row_number() OVER (PARTITION BY q.query_id ORDER BY {_COSINE} DESC, e.vec_id) AS rank
           FROM embeddings e, (SELECT label AS query_id, arg_min(embedding, vec_id) AS embedding FROM embeddings GROUP BY label) q)
        WHERE rank <= 3"""
)
def knn_batch(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    queries = first_per_id(vectors, "vec_id", "label")
    found = nearest_batch(vectors, queries, 3, query_id="label")
    return found.select("query_id", "id", F.round("score", 6).alias("score"), F.col("rank").cast("bigint").alias("rank"))


@query(
    f"""SELECT e.vec_id AS vec_id, round({_COSINE}, 6) AS score FROM embeddings e
        JOIN (SELECT label, arg_min(embedding, vec_id) AS embedding FROM embeddings GROUP BY label) q USING (label)"""
)
def cosine_to_first_of_label(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    first = first_per_id(vectors, "vec_id", "label").select("label", F.col("embedding").alias("first"))
    score = cosine_similarity(F.col("embedding"), F.col("first"))
    return join_measured(vectors, first, "label").select("vec_id", F.round(score, 6).alias("score"))


@query(
    f"""SELECT e.vec_id AS id, round({_COSINE}, 6) AS score FROM embeddings e,
        (SELECT embedding FROM embeddings ORDER BY vec_id LIMIT 1) q ORDER BY {_COSINE} DESC, e.vec_id LIMIT 3"""
)
def knn_all_cells(spark, sf_dir):
    """The index with every cell probed gives the exact neighbours."""
    vectors = table(spark, sf_dir, "embeddings")
    path = scratch_path(spark, "index")
    build_index(vectors, path, cells=16)
    first = vectors.orderBy("vec_id").select("embedding").first()["embedding"]
    return search_index(spark, path, first, k=3, probes=16).select("id", F.round("score", 6).alias("score"))


@query(
    f"""SELECT query_id, id, round(score, 6) AS score, rank, 'vector ' || id || ' of label ' || label AS text FROM
          (SELECT q.query_id, e.vec_id AS id, e.label, {_COSINE} AS score,
                  row_number() OVER (PARTITION BY q.query_id ORDER BY {_COSINE} DESC, e.vec_id) AS rank
           FROM embeddings e, (SELECT vec_id AS query_id, embedding FROM embeddings WHERE vec_id % 50 = 0) q)
        WHERE rank <= 3"""
)
def knn_batch_all_cells(spark, sf_dir):
    """A table of queries joined with the index by cell, every cell probed, and the hits' texts."""
    vectors = table(spark, sf_dir, "embeddings")
    path = scratch_path(spark, "index")
    build_index(vectors, path, cells=16)
    queries = vectors.filter("vec_id % 50 = 0").withColumnRenamed("vec_id", "query_id")
    hits = search_batch(spark, path, queries, k=3, probes=16)
    text = F.concat(F.lit("vector "), F.col("vec_id").cast("string"), F.lit(" of label "), F.col("label").cast("string"))
    hits = hits.select("query_id", "id", F.round("score", 6).alias("score"), F.col("rank").cast("bigint").alias("rank"))
    return with_payload(hits, vectors.withColumn("text", text)).select("query_id", "id", "score", "rank", "text")


@query()
def knn_approximate(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    path = scratch_path(spark, "index")
    build_index(vectors, path)
    queries = vectors.filter("vec_id % 50 = 0").withColumnRenamed("vec_id", "query_id")
    return search_batch(spark, path, queries, k=3)


@query(
    f"""SELECT round({_COSINE}, 3) AS score, left('vector ' || e.vec_id || ' of label ' || e.label, 80) AS text FROM embeddings e,
        (SELECT embedding FROM embeddings ORDER BY vec_id LIMIT 1) q ORDER BY {_COSINE} DESC, e.vec_id LIMIT 3"""
)
def knn_display(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    text = F.concat(F.lit("vector "), F.col("vec_id").cast("string"), F.lit(" of label "), F.col("label").cast("string"))
    first = vectors.orderBy("vec_id").select("embedding").first()["embedding"]
    hits = with_payload(nearest(vectors, first, 3), vectors.withColumn("text", text))
    return hit_display(hits).select("score", "text")


@query("SELECT doc_id, 64 AS dimension, 1.0::DOUBLE AS length FROM documents")
def embed_batch(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    embedded = documents.select("doc_id", embed(hashing_encoder(64), "text").alias("embedding"))
    squares = F.aggregate("embedding", F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double"))
    return embedded.select("doc_id", F.size("embedding").alias("dimension"), F.round(F.sqrt(squares), 4).alias("length"))


@query(
    f"""SELECT global_index AS id, 64 AS dimension, md5(left(text, 4096)) AS digest, local_index, sheet FROM
        (SELECT *, role AS sheet FROM ({_NUMBERED_SQL}))"""
)
def vector_roundtrip(spark, sf_dir):
    out, collection = scratch_path(spark, "embeddings"), scratch_path(spark, "collection")
    rows = _metadata(spark, sf_dir).withColumn("embedding", embed(hashing_encoder(64), "text"))
    write_embeddings(rows, out, "hashing", 64, "conversations")
    stored = read_embeddings(spark, out)
    write_collection(stored, collection, 64, text_limit=4096)
    metadata = stored.select("global_index", "local_index", "sheet")
    vectors = read_collection(spark, collection).withColumnRenamed("id", "global_index")
    return join_vectors(metadata, vectors).select(
        F.col("global_index").alias("id"),
        F.size("embedding").alias("dimension"),
        F.md5("text").alias("digest"),
        "local_index",
        "sheet",
    )


@query("SELECT CAST(doc_id AS VARCHAR) AS original_id, lang AS sheet, md5('Text: ' || text) AS digest, 32 AS dimension FROM documents")
def embed_folder_set(spark, sf_dir):
    source, out = scratch_path(spark, "notes"), scratch_path(spark, "note-vectors")
    records = table(spark, sf_dir, "documents").select(
        F.col("source").alias("dataset"),
        F.col("doc_id").alias("ord"),
        F.col("doc_id").cast("string").alias("id"),
        F.col("lang").alias("sheet"),
        F.create_map(F.lit("Text"), "text").alias("text"),
    )
    write_compact(records, source)
    embed_folder(spark, source, out, hashing_encoder(32), "hashing", 32)
    stored = read_embeddings(spark, out)
    return stored.select("original_id", "sheet", F.md5("text").alias("digest"), F.size("embedding").alias("dimension"))
