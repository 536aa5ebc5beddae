"""Benchmark decontamination: size-partitioned MinHash containment search, verified exactly."""

from __future__ import annotations

from collections.abc import Sequence
from math import comb

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notewright.llm.shingles import free_prefix
from notewright.operators.sizing import join_measured
from notewright.session import materialised

SHINGLE = 5
CONTAINMENT = 0.8
PERMUTATIONS = 32
MISS = 1e-6


def words(text: Column) -> Column:
    """Lower-case words between ASCII white space; a null text has none."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[\x20\x09-\x0D]+"), lambda w: w != "")


def _runs(size: int) -> Column:
    """Hashes of all runs of ``size`` of the words in ``__w``; none where these are fewer."""
    run = F.transform(
        F.sequence(F.lit(0), F.size("__w") - size),
        lambda i: F.xxhash64(*[F.get(F.col("__w"), i + k) for k in range(size)]),
    )
    return F.when(F.size("__w") >= size, run).otherwise(F.array().cast("array<bigint>"))


def _hashed(frame: DataFrame, text: Column) -> DataFrame:
    return frame.withColumn("__w", F.transform(words(text), lambda w: F.xxhash64(w)))


def shingles(frame: DataFrame, text: Column, into: str, sizes: Sequence[int] = (SHINGLE,)) -> DataFrame:
    """``frame`` with the hashes of all word shingles of a text, of each of ``sizes``; a text of fewer words has none of that size."""
    return _hashed(frame, text).withColumn(into, F.concat(*map(_runs, sizes))).drop("__w")


def least_hits(permutations: int, containment: float = CONTAINMENT, miss: float = MISS) -> int:
    """The most minima that may be asked for so that an item held to ``containment`` fails with probability ``miss`` at most."""
    below, hits = 0.0, 0
    while True:
        below += comb(permutations, hits) * containment**hits * (1 - containment) ** (permutations - hits)
        if below > miss:
            return max(hits, 1)
        hits += 1


def _items(benchmark: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Distinct items: item_id, variant, item (its distinct shingles), their number and their size in words.

    An item of fewer words than a shingle is one shingle of its own length; items without words are left out.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = _hashed(benchmark.select(F.col(id_col).alias("item_id"), text.alias("item_text")), F.col("item_text"))
    found = _runs(SHINGLE)
    for size in range(1, SHINGLE):
        found = F.when(F.size("__w") == size, _runs(size)).otherwise(found)
    rows = rows.select(
        "item_id",
        F.xxhash64("item_id", "item_text").alias("variant"),
        F.array_distinct(found).alias("item"),
        F.least(F.size("__w"), F.lit(SHINGLE)).alias("size"),
    )
    return rows.dropDuplicates(["item_id", "variant"]).withColumn("n_item", F.size("item")).filter("n_item > 0")


def _minima(items: DataFrame, permutations: int, containment: float) -> DataFrame:
    """What to look up: (shingle, variant, weight, least), least being the weight a candidate must reach.

    Items are partitioned by size. Up to ``permutations`` shingles, every shingle is looked up
    and the bound is exact. Above, an item is represented by the shingle with the least hash
    under each permutation; each lies in a document with probability equal to the containment.
    """
    small = items.filter(F.col("n_item") <= permutations).select(
        F.explode("item").alias("shingle"),
        "variant",
        F.lit(1).alias("weight"),
        F.ceil(F.col("n_item") * F.lit(containment) - 1e-9).cast("int").alias("least"),
    )
    seeds = F.array(*[F.lit(k) for k in range(permutations)])
    argmin = lambda k: F.array_min(
        F.transform("item", lambda s: F.struct(F.xxhash64(s, k).alias("h"), s.alias("s")))
    )["s"]
    large = (
        items.filter(F.col("n_item") > permutations)
        .select("variant", F.explode(F.transform(seeds, argmin)).alias("shingle"))
        .groupBy("shingle", "variant")
        .agg(F.count(F.lit(1)).cast("int").alias("weight"))
        .withColumn("least", F.lit(least_hits(permutations, containment)))
    )
    return small.unionByName(large)


def contained(
    docs: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    containment: float = CONTAINMENT,
    permutations: int = PERMUTATIONS,
) -> DataFrame:
    """Pairs (blob, item_id, containment) of texts and the items whose shingles they hold to ``containment`` or more.

    ``blob`` addresses the text by content, so equal texts are searched as one. Shingles of all documents are looked
    up among the items' minima, which are broadcast only if measured small; only texts with
    enough hits are compared shingle by shingle. Null and empty texts and items without words
    pair with nothing; an item of fewer words than a shingle is looked up among the documents' runs of its own
    length, which are made only where there are such items. Repeated items count once; of several
    texts under one item_id the best counts. Empty tables give no rows.
    """
    items = materialised(_items(benchmark, item_id, item_text))
    sizes = sorted({SHINGLE, *(row["size"] for row in items.select("size").distinct().collect())})  # SHINGLE of them at most
    keys = _minima(items, permutations, containment)
    by_shingle = keys.groupBy("shingle").agg(F.collect_list(F.struct("variant", "weight", "least")).alias("of"))
    keyed = docs.select(_blob(text_col).alias("blob"), F.coalesce(text_col, F.lit("")).alias("doc_text"))
    # The outer form: for the plain one the optimizer adds a filter on the array, below which it is computed once more.
    scanned = shingles(keyed, F.col("doc_text"), "found", sizes).select("blob", F.explode_outer("found").alias("shingle"))
    candidates = materialised(
        join_measured(scanned, by_shingle, "shingle")
        .select("blob", "shingle", F.explode("of").alias("of"))
        .groupBy("blob", "shingle", "of.variant", "of.weight", "of.least")
        .agg(F.lit(1).alias("one"))
        .groupBy("blob", "variant")
        .agg(F.sum("weight").alias("hits"), F.max("least").alias("least"))
        .filter(F.col("hits") >= F.col("least"))
        .select("blob", "variant")
    )
    texts = join_measured(keyed, candidates.select("blob").distinct(), "blob", "left_semi").dropDuplicates(["blob"])
    sets = shingles(texts, F.col("doc_text"), "found", sizes).select("blob", F.array_distinct("found").alias("found"))
    shared = F.size(F.array_intersect("found", "item"))
    return (
        candidates.join(sets, "blob")
        .join(items, "variant")
        .select("blob", "item_id", shared.alias("shared"), "n_item")
        .filter(F.col("shared") >= F.ceil(F.col("n_item") * F.lit(containment) - 1e-9))
        .groupBy("blob", "item_id")
        .agg(F.max(F.col("shared") / F.col("n_item")).alias("containment"))
    )


def _blob(text_col: str) -> Column:
    return F.unhex(F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256))


def contaminated(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """(doc_id, item_id, containment) for every row of ``docs`` that holds an item; see ``contained``."""
    pairs = contained(docs, benchmark, doc_id, text_col, **how)
    found = materialised(pairs.groupBy("blob").agg(F.collect_list(F.struct("item_id", "containment")).alias("items")))
    rows = docs.select(F.col(doc_id).alias("doc_id"), _blob(text_col).alias("blob"))
    return join_measured(rows, found, "blob").select("doc_id", F.explode("items").alias("i")).select("doc_id", "i.*")


def clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **how) -> DataFrame:
    """The rows of ``docs`` that hold no item, with the same columns; see ``contained``."""
    found = materialised(contained(docs, benchmark, text_col=text_col, **how).select("blob").distinct())
    blob = f"{free_prefix(docs.columns)}blob"
    marked = docs.withColumn(blob, _blob(text_col))
    return join_measured(marked, found.withColumnRenamed("blob", blob), blob, "left_anti").select(*[f"`{c}`" for c in docs.columns])
