"""Approximate nearest neighbours over vectors stored by cluster.

The corpus is written once, partitioned by the nearest of a fixed number of k-means
centres. A search ranks the centres, reads only the partitions of the nearest ones,
and scores those rows exactly, so the work of a query does not grow with the rest.
A table of queries meets the corpus by a join on the cell.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import Normalizer
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from notewright.operators.sizing import join_measured
from notewright.operators.vectors import QUERY_BLOCK, _best, _top, nearest, nearest_batch
from notewright.session import materialised

RECALL = 0.9  # mean share of the exact neighbours that a search by default has to find
MEASURED = (1, 3, 10, 30)  # numbers of neighbours for which this is measured; a search for more reads all cells
MOST_CELLS = 4096  # by default
FIT_ROWS = 500_000  # vectors on which the centres are fitted, at most about
MEASURED_QUERIES = 1000  # queries with which the recall is measured, at most
CELL_ROWS = 50_000  # of one cell in one place when it meets queries, about


def _unit(matrix: np.ndarray) -> np.ndarray:
    lengths = np.linalg.norm(matrix, axis=-1, keepdims=True)
    return matrix / np.where(lengths == 0, 1.0, lengths)


def build_index(
    corpus: DataFrame,
    path: str,
    cells: int | None = None,
    id: str = "vec_id",
    embedding: str = "embedding",
    seed: int = 0,
    max_iter: int = 10,
) -> None:
    """Write the corpus below ``path``, partitioned by cell, and the centres next to it.

    Every vector is stored. Without ``cells`` their number is the square root of the number of vectors, ``MOST_CELLS`` at
    most; the centres are fitted on about ``FIT_ROWS`` vectors at most, chosen by a hash of the id. How many cells a search has
    to read for its recall is measured with the vectors whose id is divisible by 50, of which a hash chooses ``MEASURED_QUERIES`` at
    most, against exact search over all vectors, and stored next to the centres. So the work grows with the rows, not with their square.

    Vectors are scaled to unit length first: on the unit sphere the order by Euclidean
    distance, which k-means uses, is the order by cosine.
    """
    spark = corpus.sparkSession
    total = corpus.count()
    if cells is None:
        cells = min(MOST_CELLS, max(1, round(total**0.5)))
    share = F.pmod(F.xxhash64(F.lit("fit"), F.col(id)), F.lit(1_000_000)) < max(1, 1_000_000 * FIT_ROWS // max(1, total))
    chosen = corpus.filter(share) if total > FIT_ROWS else corpus
    vectors = chosen.select(array_to_vector(F.col(embedding).cast("array<double>")).alias("vector"))
    training = Normalizer(inputCol="vector", outputCol="features").transform(vectors).select("features")
    model = KMeans(k=cells, seed=seed, maxIter=max_iter).fit(training)
    centres = np.asarray(model.clusterCenters())

    @F.pandas_udf("int")
    def cell_of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        squares = (centres**2).sum(axis=1)
        for vectors in batches:
            unit = _unit(np.stack(vectors.to_numpy()).astype(np.float64))
            yield pd.Series((squares - 2 * unit @ centres.T).argmin(axis=1))

    rows = corpus.withColumn("cell", cell_of(embedding))
    # Rebalancing gathers the rows of a cell and still cuts a cell that holds far more than its share.
    rows.hint("rebalance", "cell").write.mode("overwrite").partitionBy("cell").parquet(f"{path}/cells")
    sizes = dict(map(tuple, spark.read.parquet(f"{path}/cells").groupBy("cell").count().collect()))  # a row per cell
    table = [(i, [float(x) for x in centre], sizes.get(i, 0)) for i, centre in enumerate(centres)]
    spark.createDataFrame(table, "cell int, centre array<double>, n bigint").coalesce(1).write.mode("overwrite").parquet(
        f"{path}/centres"
    )
    measured = spark.createDataFrame(_measure(spark, path, centres, id, embedding), "k int, probes int, recall double")
    measured.coalesce(1).write.mode("overwrite").parquet(f"{path}/probes")


def _measure(spark: SparkSession, path: str, centres: np.ndarray, id: str, embedding: str) -> list[tuple[int, int, float]]:
    """(k, probes, recall): the fewest cells with which a search for k finds ``RECALL`` of the exact neighbours on average."""
    stored = spark.read.parquet(f"{path}/cells").select(F.col(id).cast("bigint").alias("id"), F.col(embedding).alias("vector"), "cell")
    queries = stored.filter("id % 50 = 0").orderBy(F.xxhash64(F.lit("measure"), F.col("id")), "id").limit(MEASURED_QUERIES)
    queries = materialised(queries.select(F.col("id").alias("query_id"), F.col("vector").alias("query")))

    @F.pandas_udf("int")
    def place_of(vectors: pd.Series, cells: pd.Series) -> pd.Series:
        unit = _unit(np.stack(vectors.to_numpy()).astype(np.float64))
        distance = (centres**2).sum(axis=1) - 2 * unit @ centres.T
        own = distance[np.arange(len(unit)), cells.to_numpy()]
        return pd.Series((distance < own[:, None]).sum(axis=1).astype(np.int32))

    exact = nearest_batch(stored, queries, max(MEASURED), query_vector="query", id="id", embedding="vector")
    # Both are bounded: MEASURED_QUERIES queries, and as many neighbours of each as are measured.
    cell_of = stored.select("id", "cell").join(F.broadcast(exact), "id").join(F.broadcast(queries), "query_id")
    rows = cell_of.select("rank", place_of("query", "cell").alias("place")).groupBy("rank", "place").count().collect()
    measured = []
    for k in MEASURED if rows else ():
        found = np.zeros(len(centres))
        for row in rows:
            if row["rank"] <= k:
                found[row["place"]] += row["count"]
        shares = found.cumsum() / found.sum()
        probes = int(np.argmax(shares >= min(RECALL, shares[-1]))) + 1
        measured.append((k, probes, float(shares[probes - 1])))
    return measured


def default_probes(spark: SparkSession, path: str, k: int) -> int | None:
    """Cells to read for ``k`` neighbours, as measured for the next larger number; None (all cells) where none was measured."""
    rows = spark.read.parquet(f"{path}/probes").filter(F.col("k") >= k).orderBy("k").head(1)
    return rows[0]["probes"] if rows else None


def search_batch(
    spark: SparkSession, path: str, queries: DataFrame, k: int = 3, probes: int | None = None,
    query_id: str = "query_id", query_vector: str = "embedding", id: str = "vec_id", embedding: str = "embedding",
) -> DataFrame:
    """``(query_id, id, score, rank)`` for a table of query vectors, each scored with the rows of its nearest cells only.

    Queries are rows throughout: each goes to the cells it reads (further ones where the nearest hold less than ``k`` rows) and meets
    their vectors there. Cells of more than ``CELL_ROWS`` vectors are cut into several places, to all of which their queries go,
    and the queries of a cell into blocks, each of which gets its vectors. Null query vectors have no neighbours.
    """
    rows = spark.read.parquet(f"{path}/centres").orderBy("cell").collect()  # one row per cell, fixed when built
    centres, sizes = np.asarray([row["centre"] for row in rows]), np.asarray([row["n"] for row in rows])
    probes = probes or default_probes(spark, path, k) or len(rows)
    queries = queries.select(F.col(query_id).cast("bigint").alias("query_id"), F.col(query_vector).alias("vector"))
    asked = queries.filter("vector is not null").mapInArrow(_cells_read(centres, sizes, k, probes), "query_id bigint, vector array<double>, cell int")
    asked = materialised(asked)
    places = F.ceil(F.col("n") / CELL_ROWS).alias("places")
    blocks = F.ceil(F.col("asking") / QUERY_BLOCK).alias("blocks")
    dealt = asked.groupBy("cell").agg(F.count(F.lit(1)).alias("asking")).join(spark.read.parquet(f"{path}/centres"), "cell")
    dealt = F.broadcast(dealt.select("cell", places, blocks))  # a row per cell
    upto = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1))
    vector = F.col(embedding).cast("array<double>").alias("vector")
    stored = spark.read.parquet(f"{path}/cells").select(F.col(id).cast("bigint").alias("id"), vector, "cell").join(dealt, "cell")
    stored = stored.select("cell", F.pmod(F.xxhash64("id"), "places").alias("place"), upto("blocks").alias("block"), F.lit(False).alias("asks"), "id", "vector")
    asked = asked.join(dealt, "cell").withColumn("block", F.pmod(F.xxhash64("query_id"), "blocks"))
    asked = asked.select("cell", upto("places").alias("place"), "block", F.lit(True).alias("asks"), F.col("query_id").alias("id"), "vector")
    group = ["cell", "place", "block"]
    met = stored.unionByName(asked).repartition(*group).sortWithinPartitions(*group, "asks")
    return _top(met.mapInArrow(_meet(k), "query_id bigint, id bigint, score double"), k)


def _cells_read(centres: np.ndarray, sizes: np.ndarray, k: int, probes: int):
    """Each query once for every cell it reads: the nearest ``probes``, and further ones until they hold ``k`` vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squares = (centres**2).sum(axis=1)
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = batch.column(1).cast(pa.list_(pa.float64()))
            matrix = vectors.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            for start in range(0, len(matrix), _QUERIES_AT_ONCE):
                part = _unit(matrix[start : start + _QUERIES_AT_ONCE])
                order = np.argsort(squares - 2 * part @ centres.T, axis=1, kind="stable")
                before = sizes[order].cumsum(axis=1) - sizes[order]
                read = ((np.arange(len(centres)) < probes) | (before < k)) & (sizes[order] > 0)
                at, cells = np.nonzero(read)[0], order[read].astype(np.int32)
                for cut in range(0, len(at), _QUERIES_AT_ONCE):
                    taken = pa.array(at[cut : cut + _QUERIES_AT_ONCE] + start)
                    columns = [batch.column(0).take(taken), vectors.take(taken), pa.array(cells[cut : cut + _QUERIES_AT_ONCE])]
                    yield pa.RecordBatch.from_arrays(columns, ["query_id", "vector", "cell"])

    return run


_QUERIES_AT_ONCE = 1024


def _meet(k: int):
    """Best ``k`` vectors per query of every (cell, place, block), whose vectors come before its queries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, held = None, []
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(4)])
            ends = [*(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1), batch.num_rows]
            start = 0
            for end in ends:
                group, part = tuple(keys[:3, start]), batch.slice(start, end - start).select([4, 5])
                if group != own:
                    own, held = group, []
                if not keys[3, start]:
                    held.append(part)
                elif held:
                    held = [pa.Table.from_batches(held).combine_chunks().to_batches()[0]]
                    ids = part.column(0).to_numpy(zero_copy_only=False)
                    matrix = part.column(1).flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1)
                    yield from _best(k, ids, matrix)(iter(held))
                start = end

    return run


def search_index(
    spark: SparkSession,
    path: str,
    query: Sequence[float],
    k: int = 3,
    probes: int | None = None,
    id: str = "vec_id",
    embedding: str = "embedding",
) -> DataFrame:
    """``(id, score, rank)`` of the ``k`` best rows among the ``probes`` nearest cells, and further ones until ``k`` are found.

    Without ``probes`` as many cells are read as the index was measured to need.
    """
    centres = spark.read.parquet(f"{path}/centres").collect()  # one row per cell, fixed when built
    unit = _unit(np.asarray(query, dtype=np.float64))
    by_distance = sorted(centres, key=lambda row: float(((np.asarray(row["centre"]) - unit) ** 2).sum()))
    stored = spark.read.parquet(f"{path}/cells")
    probes = probes or default_probes(spark, path, k) or len(centres)
    while True:
        cells = [row["cell"] for row in by_distance[:probes]]
        rows = stored.filter(F.col("cell").isin(*cells))
        if probes >= len(by_distance) or rows.count() >= k:  # counted from the files' footers
            return nearest(rows, query, k, id, embedding)
        probes *= 2


def recall(approximate: DataFrame, exact: DataFrame) -> DataFrame:
    """One row: share of the exact neighbours that the approximate search found."""
    found = join_measured(exact.select("id"), approximate.select("id", F.lit(True).alias("hit")), "id", "left")
    return found.agg((F.count_if("hit") / F.greatest(F.count(F.lit(1)), F.lit(1))).alias("recall"))
