import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from notewright import embed_folder, numbered_texts
from notewright.operators import ann
from notewright.operators.ann import build_index, recall, search_index
from notewright.operators.encoders import HashingEncoder, hashing_encoder
from notewright.operators.vectors import (
    cosine_similarity,
    embedding_text,
    embedding_text_of_json,
    hit_display,
    nearest,
    nearest_batch,
    with_payload,
)
from notewright.sinks.vectors import write_collection
from notewright.sources.vectors import join_vectors, read_collection, read_embeddings


def python_text(document):
    text = document.get("text", {})
    if not isinstance(text, dict):
        return str(text) if text else ""
    return " | ".join(f"{k}: {v if isinstance(v, (str, bool, int)) else json.dumps(v, separators=(',', ':'))}" for k, v in text.items() if v)


def test_embedding_texts(spark):
    documents = [
        {"text": {"b": "x", "a": "", "c": None, "Z": "0"}},
        {"text": {"n": 0, "m": 5, "t": True, "f": False, "e": [], "o": {}, "l": [1, 2], "d": {"k": "v"}}},
        {"text": "plain"},
        {"text": ""},
        {"text": 0},
        {"id": "no text"},
        {"text": {}},
    ]
    frame = spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(documents)], "i int, raw string")
    got = frame.select("i", embedding_text_of_json(F.col("raw")).alias("t")).orderBy("i").collect()
    assert [r["t"] for r in got] == [python_text(d) for d in documents]
    repeated = spark.createDataFrame([('{"text":{"a":"1","b":"2","a":"3"}}',)], "raw string")
    assert repeated.select(embedding_text_of_json(F.col("raw"))).first()[0] == "a: 3 | b: 2"
    plain = spark.sql("select map_from_arrays(array('b', 'a', 'c'), array('x', '', null)) as text")
    assert plain.select(embedding_text()).first()[0] == "b: x"


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(12, 16))
    matrix = (centres[rng.integers(0, 12, 1500)] + 0.3 * rng.normal(size=(1500, 16))).astype(np.float32)
    matrix[700:1100] = matrix[5]  # exact copies: more than a quarter of the rows tie
    matrix[3] = 0
    rows = [(int(i), [float(x) for x in v]) for i, v in enumerate(matrix)]
    return matrix, spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").repartition(5)


def brute(matrix, query, k):
    matrix, query = matrix.astype(np.float64), np.asarray(query, dtype=np.float64)
    norms = np.linalg.norm(matrix, axis=1)
    scores = matrix @ (query / np.linalg.norm(query)) / np.where(norms == 0, 1, norms)
    # Copies of a vector must tie exactly, however their sums are ordered.
    order = sorted(range(len(matrix)), key=lambda i: (-round(float(scores[i]), 9), i))
    return order[:k], scores


@pytest.mark.parametrize("k", [1, 3, 50])
def test_nearest(spark, vectors, k):
    matrix, frame = vectors
    for at in (0, 42, 1200):
        want, scores = brute(matrix, matrix[at], k)
        got = nearest(frame, matrix[at].tolist(), k).orderBy("rank").collect()
        assert np.allclose([r["score"] for r in got], scores[want], atol=1e-9)
        assert {r["id"] for r in got} == set(want) or len({round(s, 9) for s in scores[want]}) < k


def test_batch_in_blocks(spark, vectors, monkeypatch):
    matrix, frame = vectors
    monkeypatch.setattr("notewright.operators.vectors._SCORES_AT_ONCE", 2000)
    queries = frame.filter("vec_id between 100 and 130").withColumnRenamed("vec_id", "query_id")
    got = nearest_batch(frame, queries, 4, block=7).collect()
    assert len(got) == 31 * 4
    for at in range(100, 131):
        _, scores = brute(matrix, matrix[at], 4)
        mine = sorted((r for r in got if r["query_id"] == at), key=lambda r: r["rank"])
        assert np.allclose([r["score"] for r in mine], np.sort(scores)[::-1][:4], atol=1e-9)
        assert mine[0]["id"] == at
    assert nearest_batch(frame, queries.limit(0), 4).count() == 0


def test_cosine_expression(spark, vectors):
    matrix, frame = vectors
    query = F.array(*[F.lit(float(x)) for x in matrix[9]])
    got = {r["vec_id"]: r["s"] for r in frame.select("vec_id", cosine_similarity(F.col("embedding"), query).alias("s")).collect()}
    _, scores = brute(matrix, matrix[9], 1)
    assert np.allclose([got[i] for i in range(len(matrix))], scores, atol=1e-12)


def test_index_recall(spark, vectors, tmp_path):
    matrix, frame = vectors
    path = str(tmp_path / "index")
    build_index(frame, path, cells=12)
    found = []
    for at in (0, 42, 400, 1300):
        exact = nearest(frame, matrix[at].tolist(), 5)
        found.append(recall(search_index(spark, path, matrix[at].tolist(), 5, probes=4), exact).first()["recall"])
    assert np.mean(found) >= 0.9
    everything = search_index(spark, path, matrix[42].tolist(), 5, probes=12).collect()
    assert sorted(r["score"] for r in everything) == pytest.approx(
        sorted(r["score"] for r in nearest(frame, matrix[42].tolist(), 5).collect())
    )
    plan = search_index(spark, path, matrix[0].tolist(), 5, probes=2)._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(cell" in plan or "cell#" in plan.split("PartitionFilters")[1][:80]


def test_encoder_is_unit_length_and_repeatable():
    encoder = HashingEncoder(32, seed=4)
    matrix = encoder.encode(["a b a", "", "Ünïcode text", "a b a"])
    assert np.allclose(np.linalg.norm(matrix, axis=1), 1) and (matrix[0] == matrix[3]).all()


def test_folder_to_neighbours(spark, tmp_path):
    source = tmp_path / "notes"
    (source / "sub" / "deep").mkdir(parents=True)

    def record(i, text, **extra):
        return json.dumps({"id": f"r{i}", "sheet": "S", "text": text, **extra}, indent=2)

    (source / "a.jsonl").write_text(
        "\n".join([record(0, {"Function": "draw a sprite"}, metadata={"file_name": "a.xlsx", "row_index": 4}), record(1, {}), '{"id": "x"}', record(2, {"Function": "play a sound", "Zero": 0})])
    )
    (source / "sub" / "deep" / "b.jsonl").write_text(record(3, {"Function": "draw text", "N": "y" * 5000}) + record(4, "plain"))
    (source / "sub" / "c.jsonl").write_text("no objects")
    rows = numbered_texts(spark, str(source)).orderBy("global_index").collect()
    got = [(r["global_index"], r["source_file"], r["local_index"], r["original_id"], r["file_name"], r["row_index"]) for r in rows]
    assert got == [
        (0, "a.jsonl", 0, "r0", "a.xlsx", 4),
        (1, "a.jsonl", 2, "r2", "", -1),
        (2, "sub/deep/b.jsonl", 0, "r3", "", -1),
        (3, "sub/deep/b.jsonl", 1, "r4", "", -1),
    ]
    assert [r["text"] for r in rows][:2] == ["Function: draw a sprite", "Function: play a sound"] and rows[3]["text"] == "plain"

    out, collection = str(tmp_path / "set"), str(tmp_path / "collection")
    embed_folder(spark, str(source), out, hashing_encoder(48), "hashing", 48)
    info = spark.read.json(f"{out}/info").first()
    assert (info["num_embeddings"], info["num_source_files"], info["num_subfolders_processed"]) == (4, 2, 1)
    assert info["source_folder"] == "notes" and info["embedding_dimension"] == 48
    assert [r["folder"] for r in spark.read.json(f"{out}/subfolders").collect()] == ["sub/deep"]

    stored = read_embeddings(spark, out)
    with pytest.raises(Exception, match="vector length is not 384"):
        write_collection(stored, str(tmp_path / "wrong"), 384)
    write_collection(stored, collection, 48)
    assert read_collection(spark, collection).agg(F.max(F.length("text"))).first()[0] > 4096
    write_collection(stored, collection, 48, text_limit=4096)  # a second load replaces the first
    corpus = read_collection(spark, collection)
    assert corpus.count() == 4 and corpus.agg(F.max(F.length("text"))).first()[0] == 4096
    query = HashingEncoder(48).encode(["Function: draw a sprite"])[0].tolist()
    hits = with_payload(nearest(corpus, query, 3, id="id"), corpus, id="id")
    shown = hit_display(hits).orderBy("rank").collect()
    assert shown[0]["text"] == "Function: draw a sprite" and shown[0]["score"] == 1.0 and len(shown) == 3
    assert max(len(r["text"]) for r in shown) <= 80
    joined = join_vectors(stored.drop("embedding"), stored.select("global_index", "embedding"))
    assert joined.count() == 4


def test_default_probes_reach_the_recall(spark, tmp_path):
    rng = np.random.default_rng(7)
    matrix = rng.normal(size=(2000, 16)).astype(np.float32)  # no clusters: few cells hold few of the neighbours
    frame = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(matrix)], "vec_id bigint, embedding array<float>")
    path = str(tmp_path / "index")
    build_index(frame, path)
    queries = frame.filter("vec_id % 50 = 0").withColumnRenamed("vec_id", "query_id")
    for k in (3, 10):
        hits = {(r["query_id"], r["id"]) for r in ann.search_batch(spark, path, queries, k).collect()}
        exact = {(r["query_id"], r["id"]) for r in nearest_batch(frame, queries, k).collect()}
        assert len(hits) == len(exact) == 40 * k and len(hits & exact) >= 0.9 * len(exact)
        one = {(50, r["id"]) for r in search_index(spark, path, matrix[50].tolist(), k).collect()}
        assert one == {pair for pair in hits if pair[0] == 50}
    assert spark.read.parquet(f"{path}/probes").filter("recall < 0.9").count() == 0


def test_batch_by_cells_with_large_cells_and_many_queries(spark, vectors, tmp_path, monkeypatch):
    matrix, frame = vectors
    path = str(tmp_path / "index")
    build_index(frame, path, cells=12)
    monkeypatch.setattr(ann, "CELL_ROWS", 60)
    monkeypatch.setattr(ann, "QUERY_BLOCK", 7)
    queries = frame.filter("vec_id % 9 = 0").withColumnRenamed("vec_id", "query_id")
    got = ann.search_batch(spark, path, queries.unionByName(queries.limit(1).select(F.lit(-1).alias("query_id"), F.lit(None).alias("embedding"))), 4, probes=12)
    want = nearest_batch(frame, queries, 4)
    rows = lambda found: sorted((r["query_id"], r["rank"], round(r["score"], 9)) for r in found.collect())
    assert rows(got) == rows(want) and got.count() == 4 * queries.count()
    plan = got._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    few = ann.search_batch(spark, path, queries.limit(2), 1500, probes=1)
    assert few.groupBy("query_id").count().filter("count = 1500").count() == 2
    assert ann.search_batch(spark, path, queries.limit(0), 4).count() == 0


def test_index_built_on_samples(spark, vectors, tmp_path, monkeypatch):
    matrix, frame = vectors
    monkeypatch.setattr(ann, "FIT_ROWS", 300)
    monkeypatch.setattr(ann, "MEASURED_QUERIES", 10)
    path = str(tmp_path / "index")
    build_index(frame, path)
    assert spark.read.parquet(f"{path}/cells").count() == len(matrix)
    assert spark.read.parquet(f"{path}/centres").agg(F.sum("n")).first()[0] == len(matrix)
    everything = ann.search_batch(spark, path, frame.filter("vec_id = 42").withColumnRenamed("vec_id", "query_id"), 5, probes=10**6)
    assert [r["id"] for r in everything.orderBy("rank").collect()] == brute(matrix, matrix[42], 5)[0]
