"""Cleaning, record building, statistics and column patterns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from notewright.functions.text import (
    clean_text,
    is_labeled,
    normal_header,
    sheet_name_for_id,
    snake_key,
    title_case,
    workbook_id,
)
from notewright.operators.census import pattern_sheets, rank_patterns, sheet_columns, sheets_by_file, sheets_like, target_rows
from notewright.operators.records import records_from_table, records_from_workbooks
from notewright.operators.stats import data_overview, distinct_files, length_statistics, processing_summary, quality_rates
from notewright.plans.registry import query, table
from notewright.plans.sqltext import lines_sql, plain_sql, words_sql


def _stats_sql(dataset: str, source: str, order: str, columns: dict[str, str]) -> str:
    """Record statistics of a table; ``columns`` maps a name to its cleaned SQL."""
    names = list(columns)
    cleaned = ", ".join(f"{sql} AS c{i}" for i, sql in enumerate(columns.values()))
    used = ", ".join(f"CASE WHEN c{i} <> '' THEN '{name}' END" for i, name in enumerate(names))
    return (
        f"SELECT '{dataset}' AS dataset, ord, array_to_string(list_filter([{used}], lambda u: u IS NOT NULL), ',') AS columns_used,"
        f" {' + '.join(f'length(c{i})' for i in range(len(names)))} AS text_length,"
        f" {' + '.join(words_sql(f'c{i}') for i in range(len(names)))} AS word_count"
        f" FROM (SELECT {order} AS ord, {cleaned} FROM {source})"
        f" WHERE {' OR '.join(f'''c{i} <> '' ''' for i in range(len(names)))}"
    )


@query(
    " UNION ALL ".join(
        [
            _stats_sql(
                "part", "part", "p_partkey",
                {"name": plain_sql("p_name"), "brand": plain_sql("p_brand"), "type_desc": plain_sql("p_type", True)},
            ),
            _stats_sql(
                "customer", "customer", "c_custkey",
                {"c_name": plain_sql("c_name"), "c_mktsegment": plain_sql("c_mktsegment")},
            ),
            _stats_sql(
                "documents", "documents", "doc_id",
                {"examples": lines_sql("text"), "lang": plain_sql("lang"), "source": plain_sql("source")},
            ),
        ]
    )
)
def row_to_record_stats(spark, sf_dir):
    part = table(spark, sf_dir, "part").select(
        "p_partkey", F.col("p_name").alias("name"), F.col("p_brand").alias("brand"), F.col("p_type").alias("type_desc")
    )
    customer = table(spark, sf_dir, "customer")
    documents = table(spark, sf_dir, "documents").withColumnRenamed("text", "examples")
    built = [
        records_from_table(part, ["name", "brand", "type_desc"], "p_partkey", F.col("brand"), F.lit("p"), "part"),
        records_from_table(customer, ["c_name", "c_mktsegment"], "c_custkey", F.col("c_name"), F.lit("c"), "customer"),
        records_from_table(
            documents, ["examples", "lang", "source"], "doc_id", F.col("source"), F.col("lang"), "documents"
        ),
    ]
    frames = [
        r.select(
            "dataset",
            "ord",
            F.array_join("columns_used", ",").alias("columns_used"),
            F.col("text_length").cast("bigint").alias("text_length"),
            F.col("word_count").cast("bigint").alias("word_count"),
        )
        for r in built
    ]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


@query(
    f"""SELECT 'documents' AS origin, doc_id AS id, md5({plain_sql("text")}) AS digest FROM documents
        UNION ALL SELECT 'benchmark', item_id, md5({plain_sql("text")}) FROM benchmark
        UNION ALL SELECT 'pages', page_id, md5({plain_sql("html", True)}) FROM pages"""
)
def clean_text_plain(spark, sf_dir):
    def cleaned(name: str, key: str, value: str, header: str) -> DataFrame:
        rows = table(spark, sf_dir, name)
        digest = F.md5(clean_text(F.col(value), header))
        return rows.select(F.lit(name).alias("origin"), F.col(key).alias("id"), digest.alias("digest"))

    return (
        cleaned("documents", "doc_id", "text", "definition")
        .unionByName(cleaned("benchmark", "item_id", "text", "definition"))
        .unionByName(cleaned("pages", "page_id", "html", "desc"))
    )


@query(
    f"""SELECT 'documents' AS origin, doc_id AS id, md5({lines_sql("text")}) AS digest FROM documents
        UNION ALL SELECT 'pages', page_id, md5({lines_sql("html")}) FROM pages"""
)
def clean_text_lines(spark, sf_dir):
    def cleaned(name: str, key: str, value: str) -> DataFrame:
        digest = F.md5(clean_text(F.col(value), "description"))
        return table(spark, sf_dir, name).select(F.lit(name).alias("origin"), F.col(key).alias("id"), digest.alias("digest"))

    return cleaned("documents", "doc_id", "text").unionByName(cleaned("pages", "page_id", "html"))


_HEADER_SQL = """CASE WHEN p_size % 7 = 0 THEN 'Unnamed: ' || p_size WHEN p_size % 7 = 1 THEN '   '
                      WHEN p_size % 7 = 2 THEN NULL WHEN p_size % 7 = 3 THEN ' ' || replace(p_name, ' ', '_')
                      WHEN p_size % 7 = 4 THEN upper(p_name) || '-' || p_size WHEN p_size % 7 = 5 THEN '-' || p_size || '.0'
                      ELSE p_name || ' (if any)' END"""


def _headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    size, name = F.col("p_size").cast("string"), F.col("p_name")
    kind = F.col("p_size") % 7
    header = (
        F.when(kind == 0, F.concat(F.lit("Unnamed: "), size))
        .when(kind == 1, F.lit("   "))
        .when(kind == 2, F.lit(None))
        .when(kind == 3, F.concat(F.lit(" "), F.replace(name, F.lit(" "), F.lit("_"))))
        .when(kind == 4, F.concat(F.upper(name), F.lit("-"), size))
        .when(kind == 5, F.concat(F.lit("-"), size, F.lit(".0")))
        .otherwise(F.concat(name, F.lit(" (if any)")))
    )
    return table(spark, sf_dir, "part").select("p_partkey", header.alias("header"), (kind == 5).alias("numeric"))


@query(
    f"""SELECT p_partkey,
               coalesce(trim(h) <> '' AND NOT starts_with(lower(trim(h)), 'unnamed'), false) AS labeled,
               array_to_string(list_transform(list_filter(string_split(replace(replace(h, '_', ' '), '-', ' '), ' '),
                   lambda w: w <> ''), lambda w: upper(w[1]) || lower(w[2:])), ' ') AS title,
               replace(replace(lower(h), ' ', '_'), '-', '_') AS snake,
               CASE WHEN p_size % 7 = 5 THEN '-' || p_size ELSE trim(h) END AS normal
        FROM (SELECT p_partkey, p_size, {_HEADER_SQL} AS h FROM part)"""
)
def labeled_columns(spark, sf_dir):
    header, numeric = F.col("header"), F.col("numeric")
    return _headers(spark, sf_dir).select(
        "p_partkey",
        is_labeled(header, numeric).alias("labeled"),
        title_case(header).alias("title"),
        snake_key(header).alias("snake"),
        normal_header(header, numeric).alias("normal"),
    )


@query(
    r"""SELECT page_id, regexp_replace(regexp_replace(f, '(?i)\.xlsx$', ''), '_references$', '') AS id,
               left(regexp_replace(regexp_replace(url, '[^\w\s-]', '', 'g'), '\s+', '_', 'g'), 50) AS safe
        FROM (SELECT page_id, url, url || CASE WHEN page_id % 2 = 0 THEN '_references.XLSX' ELSE '.xlsx' END AS f FROM pages)"""
)
def workbook_names(spark, sf_dir):
    ending = F.when(F.col("page_id") % 2 == 0, F.lit("_references.XLSX")).otherwise(F.lit(".xlsx"))
    pages = table(spark, sf_dir, "pages").withColumn("file", F.concat("url", ending))
    return pages.select(
        "page_id", workbook_id(F.col("file")).alias("id"), sheet_name_for_id(F.col("url")).alias("safe")
    )


def _cell_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as workbook rows: file per brand, sheet per type, some cells blank."""
    part = table(spark, sf_dir, "part")
    size = F.col("p_size").cast("string")

    def cell(at: int, header: str, value) -> F.Column:
        return F.struct(
            F.lit(at).alias("col"), F.lit(header).alias("header"), F.lit(False).alias("numeric"), value.alias("value")
        )

    cells = F.array(
        cell(0, "part name", F.when(F.col("p_size") % 3 != 0, F.concat(F.lit("  "), "p_name"))),
        cell(1, "Unnamed: 1", F.col("p_type")),
        cell(2, "part_name", F.when(F.col("p_size") % 5 == 0, F.upper("p_name"))),
        cell(3, "Size-Note", F.when(F.col("p_size") % 2 == 0, F.concat(F.lit("="), size)).otherwise(size)),
    )
    return part.select(
        F.concat("p_brand", F.lit("_references.xlsx")).alias("file_path"),
        F.concat("p_brand", F.lit("_references.xlsx")).alias("file_name"),
        F.lit(0).alias("sheet_index"),
        F.col("p_type").alias("sheet"),
        F.col("p_partkey").cast("int").alias("row_index"),
        cells.alias("cells"),
    )


@query(
    """SELECT p_brand AS id, p_type AS sheet, CAST(p_partkey AS INTEGER) AS row_index,
              CASE WHEN named AND sized THEN 'Part Name,Size Note' WHEN named THEN 'Part Name' ELSE 'Size Note' END AS keys,
              CASE WHEN named AND sized THEN pname || '|' || p_size WHEN named THEN pname ELSE CAST(p_size AS VARCHAR) END AS vals,
              CAST(p_size % 3 <> 0 AS INTEGER) + CAST(p_size % 5 = 0 AS INTEGER) + CAST(sized AS INTEGER) AS non_empty,
              CASE WHEN p_size % 5 = 0 THEN upper(p_name) END AS raw_column
       FROM (SELECT *, p_size % 3 <> 0 OR p_size % 5 = 0 AS named, p_size % 2 <> 0 AS sized,
                    CASE WHEN p_size % 5 = 0 THEN upper(p_name) ELSE p_name END AS pname FROM part)
       WHERE named OR sized"""
)
def nonempty_cells(spark, sf_dir):
    records = records_from_workbooks(_cell_rows(spark, sf_dir))
    return records.select(
        "id",
        "sheet",
        F.col("metadata.row_index").alias("row_index"),
        F.array_join(F.map_keys("text"), ",").alias("keys"),
        F.array_join(F.map_values("text"), "|").alias("vals"),
        F.col("metadata.non_empty_columns").alias("non_empty"),
        F.col("columns")["part_name"].alias("raw_column"),
    )


@query(
    """WITH kept AS (SELECT *, p_size % 3 <> 0 OR p_size % 5 = 0 OR p_size % 2 <> 0 AS written FROM part)
       SELECT p_brand || '_references.xlsx' AS file_name, p_type AS sheet, count(*) AS rows_read,
              count(*) FILTER (WHERE written) AS rows_written, count(*) FILTER (WHERE NOT written) AS rows_skipped
       FROM kept GROUP BY ALL"""
)
def ingestion_counts(spark, sf_dir):
    from notewright.operators.census import ingestion_tally

    rows = _cell_rows(spark, sf_dir)
    sheets = rows.select("file_name", "sheet", F.lit(1).alias("unlabeled")).distinct()
    return ingestion_tally(rows, records_from_workbooks(rows), sheets).drop("unlabeled")


@query(
    """SELECT count(*) AS files_found, count(*) FILTER (WHERE good) AS files_processed,
              count(*) FILTER (WHERE NOT good) AS files_skipped, CAST(sum(langs) AS BIGINT) AS total_sheets_processed,
              CAST(sum(n) AS BIGINT) AS total_records_created, round(sum(n) / greatest(1, count(*) FILTER (WHERE good)), 6) AS average
       FROM (SELECT source, count(*) AS n, count(DISTINCT lang) AS langs, max(n_chars) >= 10000 AS good FROM documents GROUP BY source)"""
)
def run_summary(spark, sf_dir):
    files = (
        table(spark, sf_dir, "documents")
        .groupBy("source")
        .agg(
            F.count(F.lit(1)).alias("records"),
            F.count_distinct("lang").alias("sheets"),
            (F.max("n_chars") >= 10000).alias("processed"),
            F.lit(0).alias("unlabeled"),
        )
    )
    return processing_summary(files).select(
        "files_found",
        "files_processed",
        "files_skipped",
        "total_sheets_processed",
        "total_records_created",
        F.round("average_records_per_file", 6).alias("average"),
    )


_LENGTHS_SQL = """round(avg(length(text)), 6) AS average_text_length, CAST(median(length(text)) AS DOUBLE) AS median_text_length,
                  min(length(text)) AS min_text_length, max(length(text)) AS max_text_length,
                  CAST(sum(length(text)) AS BIGINT) AS total_characters"""


@query(
    f"""SELECT lang, {_LENGTHS_SQL} FROM documents GROUP BY lang
        UNION ALL SELECT 'all', {_LENGTHS_SQL} FROM documents"""
)
def text_stats(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    by_lang = length_statistics(documents, F.length("text"), ["lang"])
    overall = length_statistics(documents, F.length("text")).withColumn("lang", F.lit("all"))
    both = by_lang.unionByName(overall)
    return both.withColumn("average_text_length", F.round("average_text_length", 6))


@query(
    """SELECT count(DISTINCT source) AS total_files, count(DISTINCT (source, lang)) AS total_sheets, count(*) AS total_records
       FROM documents"""
)
def overview(spark, sf_dir):
    return data_overview(table(spark, sf_dir, "documents"), F.col("source"), F.col("lang"))


@query("SELECT DISTINCT source AS file_name FROM documents")
def file_names(spark, sf_dir):
    return distinct_files(table(spark, sf_dir, "documents"), F.col("source"))


@query(
    """SELECT lang, round(100.0 * count(*) FILTER (WHERE quality = 1) / greatest(1, count(*)), 6) AS processing_success_rate,
              100.0::DOUBLE AS target_sheets_ratio, count(*) FILTER (WHERE quality = 0) AS error_count,
              count(*) FILTER (WHERE toxic = 1) AS warning_count
       FROM labels JOIN documents USING (doc_id) GROUP BY lang"""
)
def quality_metrics(spark, sf_dir):
    outcomes = table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents").select("doc_id", "lang"), "doc_id")
    rates = quality_rates(
        outcomes, F.col("quality") == 1, F.col("quality") == 0, F.col("toxic") == 1, ["lang"]
    )
    return rates.withColumn("processing_success_rate", F.round("processing_success_rate", 6))


def _part_sheets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every part as a sheet whose headers are the words of its name and its type."""
    words = F.concat(F.split("p_name", " "), F.array(F.lit("Unnamed: 9"), F.concat(F.lit(" "), "p_type")))
    cells = F.transform(
        words,
        lambda word, at: F.struct(at.alias("col"), word.alias("header"), F.lit(False).alias("numeric")),
    )
    headers = table(spark, sf_dir, "part").select(
        F.col("p_brand").alias("file_name"),
        F.col("p_partkey").alias("sheet_index"),
        F.concat(F.lit("sheet "), F.col("p_partkey").cast("string")).alias("sheet"),
        cells.alias("cells"),
    )
    return sheet_columns(headers)


_PATTERN_SQL = """SELECT row_number() OVER (ORDER BY n DESC, first_seen) AS rank, columns, n FROM
    (SELECT columns, count(*) AS n, min((brand, key)) AS first_seen FROM
       (SELECT array_to_string(list_concat(string_split(p_name, ' '), [' ' || p_type]), '|') AS columns,
               p_brand AS brand, p_partkey AS key FROM part) GROUP BY columns)"""


@query(f"SELECT rank, columns, n AS count FROM ({_PATTERN_SQL})")
def column_pattern_census(spark, sf_dir):
    ranks = rank_patterns(_part_sheets(spark, sf_dir))
    return ranks.select("rank", F.array_join("labels", "|").alias("columns"), "count")


@query(
    f"""SELECT rank, p_brand AS file_name, 'sheet ' || p_partkey AS sheet FROM part
        JOIN ({_PATTERN_SQL}) q ON q.columns = array_to_string(list_concat(string_split(p_name, ' '), [' ' || p_type]), '|')"""
)
def column_pattern_sheets(spark, sf_dir):
    sheets = _part_sheets(spark, sf_dir)
    return pattern_sheets(sheets, rank_patterns(sheets)).select("rank", "file_name", "sheet")


@query(
    """SELECT p_brand AS file_name, 'sheet ' || p_partkey AS sheet FROM part WHERE (p_name, p_type) IN
         (SELECT (p_name, p_type) FROM part ORDER BY p_partkey LIMIT 1)"""
)
def exact_columns(spark, sf_dir):
    sheets = _part_sheets(spark, sf_dir)
    first = sheets.orderBy("sheet_index").first()["columns"]
    return sheets_like(sheets, first).select("file_name", "sheet")


@query("SELECT p_brand AS file_name, count(*) AS n_sheets FROM part GROUP BY p_brand")
def sheet_counts_by_file(spark, sf_dir):
    return sheets_by_file(_part_sheets(spark, sf_dir))


@query(
    """SELECT doc_id, source AS file_name, lang AS sheet FROM documents d WHERE EXISTS
         (SELECT 1 FROM labels l JOIN documents t ON l.doc_id = t.doc_id
          WHERE l.toxic = 1 AND t.source = d.source AND t.lang = d.lang)"""
)
def semi_targets(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select(
        "doc_id", F.col("source").alias("file_name"), F.col("lang").alias("sheet")
    )
    toxic = table(spark, sf_dir, "labels").filter("toxic = 1").select("doc_id")
    return target_rows(documents, documents.join(toxic, "doc_id"))
