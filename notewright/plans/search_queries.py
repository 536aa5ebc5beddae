"""Search, lookup, paging and projection over tables read as records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from notewright.functions.arguments import preferred_fields
from notewright.operators.catalogue import attach_catalogue, field_catalogue
from notewright.operators.records import records_from_table
from notewright.operators.search import Dataset, first_per_id, invalid_field_names, restrict_text
from notewright.plans.registry import query, table


def document_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as records: id is the source, sheet the language, one text field."""
    documents = table(spark, sf_dir, "documents")
    return records_from_table(documents, ["text"], "doc_id", F.col("source"), F.col("lang"), "documents", clean=False)


def part_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as records with four text fields."""
    parts = table(spark, sf_dir, "part").select(
        "p_partkey",
        F.col("p_name").alias("name"),
        F.col("p_brand").alias("brand"),
        F.col("p_type").alias("type"),
        F.col("p_size").alias("size"),
    )
    columns = ["name", "brand", "type", "size"]
    return records_from_table(parts, columns, "p_partkey", F.col("brand"), F.col("type"), "part", clean=False)


def documents(spark: SparkSession, sf_dir: str) -> Dataset:
    return Dataset(document_records(spark, sf_dir), "documents", ["Text"])


def parts(spark: SparkSession, sf_dir: str) -> Dataset:
    return Dataset(part_records(spark, sf_dir), "part", ["Brand", "Name", "Size", "Type"])


@query(
    """SELECT source AS id, lang AS sheet, text AS body FROM documents
       WHERE contains(lower(text), 'the') ORDER BY doc_id LIMIT 20"""
)
def search_fulltext(spark, sf_dir):
    found = documents(spark, sf_dir).search("The")
    return found.select("id", "sheet", F.col("text")["Text"].alias("body"))


@query(
    """SELECT source AS id, lang AS sheet, text AS body FROM documents
       WHERE contains(lower(text), 'an') AND contains(lower(text), 'th') AND contains(lower(lang), 'en')
       ORDER BY doc_id LIMIT 50 OFFSET 5"""
)
def search_filters(spark, sf_dir):
    filters = {"sheet": "EN", "text.Text": "th", "text.Missing": "x", "unknown": "x"}
    found = documents(spark, sf_dir).search("an", filters, limit=50, offset=5)
    return found.select("id", "sheet", F.col("text")["Text"].alias("body"))


@query(
    """SELECT p_partkey AS ord, p_brand AS id, p_type AS sheet FROM part
       WHERE contains(lower(p_brand), '#2')
         AND (contains(lower(p_name), 'ring') OR contains(lower(p_brand), 'ring')
              OR contains(lower(p_type), 'ring') OR contains(CAST(p_size AS VARCHAR), 'ring'))"""
)
def search_matches_all(spark, sf_dir):
    return parts(spark, sf_dir).matching("RING", {"text.Brand": "#2"}).select("ord", "id", "sheet")


@query(
    """SELECT p_partkey AS ord, p_brand AS id FROM part
       WHERE contains(lower(p_type), 'econ') ORDER BY p_partkey LIMIT 5"""
)
def find_records(spark, sf_dir):
    return parts(spark, sf_dir).find(filters={"sheet": "Econ"}).select("ord", "id")


@query(
    """SELECT count(*) AS total, CAST(ceil(count(*) / 20.0) AS BIGINT) AS total_pages FROM documents
       WHERE contains(lower(text), 'the') AND contains(lower(lang), 'en')"""
)
def search_total_pages(spark, sf_dir):
    return documents(spark, sf_dir).page_info(query="the", filters={"sheet": "en"})


@query(
    """SELECT p_brand AS id, p_type AS sheet, p_name AS name, CAST(p_size AS VARCHAR) AS size FROM part
       WHERE contains(lower(p_name), 'ed') OR contains(lower(p_type), 'ed') OR contains(lower(p_brand), 'ed')
          OR contains(CAST(p_size AS VARCHAR), 'ed')
       ORDER BY p_partkey LIMIT 25 OFFSET 50"""
)
def records_page(spark, sf_dir):
    page = parts(spark, sf_dir).page(3, 25, "Size,Name", query="ed")
    return page.select("id", "sheet", F.col("text")["Name"].alias("name"), F.col("text")["Size"].alias("size"))


@query("SELECT source AS id, lang AS sheet, md5(text) AS digest FROM documents WHERE source = 'src7' ORDER BY doc_id LIMIT 1")
def lookup_by_id(spark, sf_dir):
    found = documents(spark, sf_dir).by_id("src7")
    return found.select("id", "sheet", F.md5(F.col("text")["Text"]).alias("digest"))


@query(
    """SELECT source AS id, min(doc_id) AS ord, arg_min(lang, doc_id) AS sheet, arg_min(md5(text), doc_id) AS digest
       FROM documents GROUP BY source"""
)
def first_record_per_id(spark, sf_dir):
    found = first_per_id(document_records(spark, sf_dir))
    return found.select("id", "ord", "sheet", F.md5(F.col("text")["Text"]).alias("digest"))


@query(
    """SELECT doc_id AS ord, source AS id, lang AS sheet FROM documents
       WHERE contains(lower(source), 'src1') ORDER BY doc_id LIMIT 80"""
)
def id_pattern(spark, sf_dir):
    return documents(spark, sf_dir).id_pattern("SRC1", 80).select("ord", "id", "sheet")


@query(
    """SELECT source AS id, lang AS sheet,
              CASE WHEN length(text) > 100 THEN left(text, 100) || '...' ELSE text END AS "Text_preview"
       FROM documents ORDER BY doc_id LIMIT 100"""
)
def record_preview(spark, sf_dir):
    return documents(spark, sf_dir).preview(100)


@query("SELECT p_partkey AS ord, 'Type,Name' AS keys, p_type || '|' || p_name AS vals FROM part")
def format_projection(spark, sf_dir):
    data = parts(spark, sf_dir)
    wanted = preferred_fields(["Type", "Colour", "Name"], data.text_fields)
    text = restrict_text(wanted)
    return data.records.select(
        "ord",
        F.array_join(F.map_keys(text), ",").alias("keys"),
        F.array_join(F.map_values(text), "|").alias("vals"),
    )


@query("SELECT p_name AS name, p_type AS description FROM part")
def name_description(spark, sf_dir):
    return parts(spark, sf_dir).project({"name": "Name", "description": "Type"})


@query(
    """SELECT dataset, array_to_string(list_sort(list_filter(list_distinct(list_concat(['Text fr', 'Missing'], ['Chars'])),
              lambda f: NOT list_contains(fields, f))), ',') AS invalid,
              array_to_string(list_filter(['Text fr', 'Chars', 'Missing'], lambda f: list_contains(fields, f)), ',') AS available
       FROM (SELECT source AS dataset, list_concat(list(DISTINCT 'Text ' || lang), ['Chars']) AS fields
             FROM documents GROUP BY source)"""
)
def invalid_fields(spark, sf_dir):
    from notewright.plans.corpus_queries import language_records

    wanted = F.array(F.lit("Text fr"), F.lit("Chars"), F.lit("Missing"))
    catalogue = field_catalogue(language_records(spark, sf_dir))
    return catalogue.select(
        "dataset",
        F.array_join(F.array_sort(invalid_field_names(wanted, F.col("text_fields"))), ",").alias("invalid"),
        F.array_join(F.array_intersect(wanted, F.col("text_fields")), ",").alias("available"),
    )


@query(
    """SELECT d.doc_id AS ord, d.source AS dataset, c.n AS known_fields FROM documents d
       JOIN (SELECT source, count(DISTINCT lang) + 1 AS n FROM documents GROUP BY source) c USING (source)"""
)
def catalogue_join(spark, sf_dir):
    from notewright.plans.corpus_queries import language_records

    records = language_records(spark, sf_dir)
    joined = attach_catalogue(records, field_catalogue(records))
    return joined.select("ord", "dataset", F.size("text_fields").cast("bigint").alias("known_fields"))


@query(
    """SELECT 'part' AS current_file, 'Brand,Name,Size,Type' AS text_fields, count(*) AS total_records,
              arg_min(p_brand, p_partkey) AS first_id, arg_min(p_name, p_partkey) AS first_name FROM part"""
)
def schema_info(spark, sf_dir):
    info = parts(spark, sf_dir).schema_info()
    return info.select(
        "current_file",
        F.array_join("text_fields", ",").alias("text_fields"),
        "total_records",
        F.col("sample_record.id").alias("first_id"),
        F.col("sample_record.text")["Name"].alias("first_name"),
    )
