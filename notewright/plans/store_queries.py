"""Questions to a record store written from ``documents`` and ``part``."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from notewright.plans.registry import query
from notewright.plans.search_queries import document_records, part_records
from notewright.plans.store import StoredDataset, open_store, write_store
from notewright.session import scratch_path

_SLAB_ROWS = 4096


def _documents(spark: SparkSession, sf_dir: str, grams: bool) -> StoredDataset:
    path = scratch_path(spark, "store")
    write_store(document_records(spark, sf_dir), path, "ord", _SLAB_ROWS, grams)
    return open_store(spark, path, "documents", ["Text"], slab_rows=_SLAB_ROWS, grams=grams)


def _parts(spark: SparkSession, sf_dir: str) -> StoredDataset:
    path = scratch_path(spark, "store")
    write_store(part_records(spark, sf_dir), path, "ord", _SLAB_ROWS)
    return open_store(spark, path, "part", ["Brand", "Name", "Size", "Type"], slab_rows=_SLAB_ROWS)


@query(
    """SELECT doc_id AS ord, source AS id, md5(text) AS digest FROM documents
       WHERE contains(lower(text), 'license') AND contains(lower(lang), 'en')"""
)
def store_search(spark, sf_dir):
    """Full text through the trigram index, with a metadata filter beside it."""
    found = _documents(spark, sf_dir, grams=True).matching("License", {"sheet": "EN"})
    return found.select("ord", "id", F.md5(F.col("text")["Text"]).alias("digest"))


@query(
    """SELECT p_partkey AS ord, p_brand AS id FROM part WHERE contains(lower(p_name), 'old ri') AND contains(lower(p_type), 'sm')
       UNION ALL SELECT p_partkey, p_brand FROM part
       WHERE contains(lower(p_name), 'rand#1') OR contains(lower(p_brand), 'rand#1') OR contains(lower(p_type), 'rand#1')"""
)
def store_field_filters(spark, sf_dir):
    """Filters on single fields, one of them too short for the index; and a query over all fields."""
    store = _parts(spark, sf_dir)
    both = store.matching(None, {"text.Name": "OLD RI", "text.Type": "sm"}).select("ord", "id")
    return both.unionAll(store.matching("rand#1").select("ord", "id"))


@query(
    """(SELECT 'page' AS part, doc_id AS ord, source AS id, lang AS sheet FROM documents ORDER BY doc_id LIMIT 50 OFFSET 150)
       UNION ALL (SELECT 'found', doc_id, source, lang FROM documents WHERE contains(lower(text), 'the') ORDER BY doc_id LIMIT 20 OFFSET 20)
       UNION ALL SELECT 'total', count(*), '', '' FROM documents"""
)
def store_pages(spark, sf_dir):
    """A page by its places, a page of hits, and the total from the slabs' counts."""
    store = _documents(spark, sf_dir, grams=True)

    def part(name: str, found: DataFrame) -> DataFrame:
        # Formatted records carry no place of their own, which the comparison needs.
        return found.select(F.lit(name).alias("part"), F.col("metadata.ord").alias("ord"), "id", "sheet")

    store = StoredDataset(**{**store.__dict__, "metadata_fields": ("id", "sheet", "ord")})
    total = store.page_info().select(F.lit("total").alias("part"), F.col("total").alias("ord"), F.lit("").alias("id"), F.lit("").alias("sheet"))
    return part("page", store.page(4, 50)).unionByName(part("found", store.page(2, 20, query="The"))).unionByName(total)


@query(
    """SELECT source AS id, min(doc_id) AS ord, arg_min(md5(text), doc_id) AS digest FROM documents
       WHERE source IN ('src0', 'src7', 'src11') GROUP BY source"""
)
def store_lookup(spark, sf_dir):
    """First records of some ids and of one that is not there, by the index."""
    store = _documents(spark, sf_dir, grams=False)
    found = [store.full_record(name) for name in ("src0", "src7", "src11", "nowhere")]
    rows = reduce(DataFrame.unionByName, found)
    return rows.select("id", "ord", F.md5(F.col("text")["Text"]).alias("digest"))


@query("SELECT p_brand AS id, min(p_partkey) AS ord, arg_min(p_name, p_partkey) AS name FROM part GROUP BY p_brand")
def store_first_records(spark, sf_dir):
    return _parts(spark, sf_dir).first_records().select("id", "ord", F.col("text")["Name"].alias("name"))
