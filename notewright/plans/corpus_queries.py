"""Catalogues, key discovery, rewriting and file round trips."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from notewright.functions.jsontext import get_path, is_json_object
from notewright.functions.text import value_for_id
from notewright.operators.catalogue import (
    child_keys,
    compare_datasets,
    dataset_status,
    field_catalogue,
    nested_key_paths,
    record_counts,
)
from notewright.operators.records import trim_objects
from notewright.operators.rewrite import replace_column, replace_field, replace_tally, rewrite_objects, set_path
from notewright.plans.registry import query, table
from notewright.plans.search_queries import document_records
from notewright.session import scratch_path
from notewright.sinks.records import (
    compact_json,
    pretty_json,
    write_catalogues,
    write_compact,
    write_flat,
    write_json_text,
    write_pretty,
)
from notewright.sources.catalogue_files import read_catalogues
from notewright.sources.files import admit_by_size, distinct_files, files_by_folder, list_files, outside_folder
from notewright.sources.jsonl import other_lines, parse_records, read_records
from notewright.sources.nested import flatten_sets, read_cards


def language_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as records of one dataset per source, the text under a field named after its language."""
    keys = F.array(F.concat(F.lit("Text "), "lang"), F.lit("Chars"))
    values = F.array(F.col("text"), F.col("n_chars").cast("string"))
    return table(spark, sf_dir, "documents").select(
        F.col("source").alias("dataset"),
        F.col("doc_id").alias("ord"),
        F.col("doc_id").cast("string").alias("id"),
        F.col("lang").alias("sheet"),
        F.map_from_arrays(keys, values).alias("text"),
    )


_FIELDS_SQL = "array_to_string(list_sort(list_concat(list(DISTINCT 'Text ' || lang), ['Chars'])), ',')"


@query(f"SELECT source AS dataset, {_FIELDS_SQL} AS text_fields FROM documents GROUP BY source")
def text_field_catalogue(spark, sf_dir):
    catalogue = field_catalogue(language_records(spark, sf_dir))
    return catalogue.withColumn("text_fields", F.array_join("text_fields", ","))


@query(
    f"""SELECT source AS dataset, count(*) AS records, count(DISTINCT lang) + 1 AS fields, {_FIELDS_SQL} AS field_names
        FROM documents GROUP BY source"""
)
def dataset_comparison(spark, sf_dir):
    compared = compare_datasets(language_records(spark, sf_dir))
    return compared.withColumn("field_names", F.array_join("field_names", ",")).withColumn(
        "fields", F.col("fields").cast("bigint")
    )


@query(
    """SELECT source AS dataset, count(*) AS total_records, arg_min(doc_id, doc_id) AS first_ord, arg_min(lang, doc_id) AS first_sheet
       FROM documents GROUP BY source"""
)
def dataset_states(spark, sf_dir):
    status = dataset_status(language_records(spark, sf_dir))
    return status.select(
        "dataset",
        "total_records",
        F.col("sample_record.ord").alias("first_ord"),
        F.col("sample_record.sheet").alias("first_sheet"),
    )


def _uneven_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as JSON objects, some lacking a member, some with a broken end or a text that is no object."""
    kind = F.col("p_size") % 7
    head = F.concat(F.lit('{"id":"'), "p_brand", F.lit('"'))
    sheet = F.concat(F.lit(',"sheet":"'), "p_type", F.lit('"'))
    text = F.concat(F.lit(',"text":{"Name":"'), "p_name", F.lit('","Size":'), F.col("p_size").cast("string"), F.lit("}"))
    plain = F.concat(F.lit(',"text":"'), "p_name", F.lit('"'))
    end = F.lit(',"metadata":{"row_index":1}}')
    raw = (
        F.when(kind == 0, F.concat(head, sheet, end))
        .when(kind == 1, F.concat(head, text, end))
        .when(kind == 2, F.concat(F.lit('{"other":1'), sheet, text, end))
        .when(kind == 3, F.concat(head, sheet, plain, end))
        .when(kind == 4, F.concat(head, sheet, text, F.lit(',"metadata":{broken')))
        .otherwise(F.concat(head, sheet, text, end))
    )
    return table(spark, sf_dir, "part").select(F.col("p_type").alias("dataset"), F.col("p_partkey").alias("ord"), raw.alias("raw"))


@query(
    """SELECT p_type AS dataset, count(*) AS total, count(*) FILTER (WHERE p_size % 7 NOT IN (0, 3)) AS valid,
              count(*) FILTER (WHERE p_size % 7 IN (0, 3)) AS failed,
              count(*) FILTER (WHERE p_size % 7 NOT IN (0, 2)) AS embeddable
       FROM part WHERE p_size % 7 <> 4 GROUP BY ROLLUP (p_type)"""
)
def records_valid(spark, sf_dir):
    objects = _uneven_objects(spark, sf_dir).filter(is_json_object(F.col("raw")))
    return record_counts(parse_records(objects), grand_total=True)


@query(
    """SELECT p_type AS dataset, p_partkey AS ord, '{"id":"' || p_brand || '","sheet":"' || p_type || '","text":' ||
              CASE WHEN p_size % 7 = 3 THEN '"' || p_name || '"' ELSE '{"Name":"' || p_name || '","Size":' || p_size || '}' END || '}' AS trimmed
       FROM part WHERE p_size % 7 NOT IN (0, 1, 2)"""
)
def trim_record(spark, sf_dir):
    return trim_objects(_uneven_objects(spark, sf_dir)).select("dataset", "ord", "trimmed")


def _event_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as nested JSON objects with keys that depend on the event."""
    kind, user = F.col("event_type"), F.col("user_id").cast("string")
    raw = F.concat(
        F.lit('{"kind":"'), kind, F.lit('","who":{"user":"u'), user, F.lit('","'), kind, F.lit('":'), F.col("props"),
        F.lit(',"kind":{"kind":"no '), kind, F.lit('"}},"tags":[{"kind":"all '), kind, F.lit('"},"'), kind, F.lit('"]}'),
    )
    return table(spark, sf_dir, "events").select(kind.alias("dataset"), F.col("event_id").alias("ord"), raw.alias("raw"))


@query(
    """SELECT unnest(['kind', 'who', 'tags', 'who.user', 'who.kind', 'who.kind.kind']) AS path
       UNION SELECT 'who.' || event_type FROM events
       UNION SELECT 'who.' || event_type || '.' || unnest(json_keys(props)) FROM events"""
)
def nested_keys(spark, sf_dir):
    return nested_key_paths(_event_objects(spark, sf_dir))


@query("SELECT unnest(['user', 'kind']) AS key UNION SELECT event_type FROM events")
def nested_child_keys(spark, sf_dir):
    return child_keys(_event_objects(spark, sf_dir), "who")


def _event_sql(kind: str, tag: str, path: str) -> str:
    return (
        f"""'{{"kind":"' || {kind} || '","who":{{"user":"u' || user_id || '","' || event_type || '":' || props_out ||"""
        f""" ',"kind":{{"kind":"no ' || {path} || '"}}}},"tags":[{{"kind":"all ' || {tag} || '"}},"' || event_type || '"]}}'"""
    )


_CHANGED_EVENT = _event_sql("replace(event_type, 'i', 'I')", "replace(event_type, 'i', 'I')", "event_type")
_KEPT_EVENT = _event_sql("event_type", "event_type", "event_type")


@query(
    f"""SELECT event_type AS dataset, event_id AS ord, contains(event_type, 'i') AS changed,
               CASE WHEN contains(event_type, 'i') THEN {_CHANGED_EVENT} ELSE {_KEPT_EVENT} END AS raw
        FROM (SELECT *, CASE WHEN contains(event_type, 'i') THEN replace(props, ': ', ':') ELSE props END AS props_out FROM events)"""
)
def replace_deep(spark, sf_dir):
    return rewrite_objects(_event_objects(spark, sf_dir), "kind", "i", "I")


@query(
    f"""SELECT event_type AS dataset, event_id AS ord, event_type = 'error' AS changed,
               CASE WHEN event_type = 'error' THEN {_event_sql("event_type", "event_type", "'ERROR'")} ELSE {_KEPT_EVENT} END AS raw
        FROM (SELECT *, CASE WHEN event_type = 'error' THEN replace(props, ': ', ':') ELSE props END AS props_out FROM events)"""
)
def replace_at_path(spark, sf_dir):
    return rewrite_objects(_event_objects(spark, sf_dir), "who.kind.kind", "error", "ERROR")


@query(
    """SELECT doc_id AS ord, contains(text, 'the') AS changed, md5(replace(text, 'the', 'THE')) AS digest FROM documents
       UNION ALL SELECT conv_id * 1000 + turn, contains(text, 'the'), md5(replace(text, 'the', 'THE')) FROM conversations"""
)
def replace_text(spark, sf_dir):
    documents = replace_field(document_records(spark, sf_dir), "Text", "the", "THE")
    turns = replace_column(table(spark, sf_dir, "conversations"), "text", "the", "THE")
    return documents.select("ord", "changed", F.md5(F.col("text")["Text"]).alias("digest")).unionByName(
        turns.select((F.col("conv_id") * 1000 + F.col("turn")).alias("ord"), "changed", F.md5("text").alias("digest"))
    )


@query(
    """SELECT source AS dataset, CAST(sum(n) AS BIGINT) AS objects, CAST(sum(c) AS BIGINT) AS changes,
              count(*) FILTER (WHERE c > 0) AS files_modified
       FROM (SELECT source, count(*) AS n, count(*) FILTER (WHERE contains(text, 'Whthe')) AS c FROM documents GROUP BY source)
       GROUP BY ROLLUP (source)"""
)
def replace_counts(spark, sf_dir):
    changed = replace_field(document_records(spark, sf_dir), "Text", "Whthe", "-").withColumn("dataset", F.col("id"))
    return replace_tally(changed, grand_total=True)


@query(
    """SELECT source AS dataset, CAST(sum(n) AS BIGINT) AS objects, CAST(sum(c) AS BIGINT) AS changes,
              count(*) FILTER (WHERE c > 0) AS files_modified
       FROM (SELECT event_type AS source, count(*) AS n, count(*) FILTER (WHERE contains(event_type, 'ick')) AS c FROM events GROUP BY 1)
       GROUP BY ROLLUP (source)"""
)
def replace_job(spark, sf_dir):
    from notewright.plans.corpus import rewrite_folder

    source = scratch_path(spark, "replace-in")
    write_json_text(_event_objects(spark, sf_dir), source, "raw")
    return rewrite_folder(spark, source, scratch_path(spark, "replace-out"), "kind", "ick", "ICK", mode="lines")


_ROUND_TRIP = "SELECT source AS dataset, doc_id, lang AS sheet, length(text) AS chars, md5(text) AS digest FROM documents"


def _written(spark: SparkSession, sf_dir: str, name: str, pretty: bool) -> str:
    path = scratch_path(spark, name)
    records = table(spark, sf_dir, "documents").select(
        F.col("source").alias("dataset"),
        F.col("doc_id").alias("ord"),
        F.col("doc_id").cast("string").alias("id"),
        F.col("lang").alias("sheet"),
        F.create_map(F.lit("Text"), "text").alias("text"),
    )
    if pretty:
        write_pretty(records, path, folder="dataset", fields=("id", "sheet", "text"))
    else:
        write_compact(records, path)
    return path


def _read_back(spark: SparkSession, path: str, mode: str) -> DataFrame:
    text = F.col("text")["Text"]
    return read_records(spark, path, mode).select(
        "dataset",
        F.col("id").cast("bigint").alias("doc_id"),
        "sheet",
        F.length(text).cast("bigint").alias("chars"),
        F.md5(text).alias("digest"),
    )


def _broken(spark: SparkSession, sf_dir: str, name: str, pretty: bool) -> str:
    """Record files, one per source, with a line of junk in place of every seventh document from number 100 on."""
    path = scratch_path(spark, name)
    record = F.struct(
        F.col("doc_id").cast("string").alias("id"),
        F.col("lang").alias("sheet"),
        F.create_map(F.lit("Text"), "text").alias("text"),
    )
    junk = (F.col("doc_id") % 7 == 3) & (F.col("doc_id") >= 100)
    value = F.when(junk, F.lit("neither object nor value")).otherwise(pretty_json(record) if pretty else compact_json(record))
    rows = table(spark, sf_dir, "documents").select(F.col("source").alias("dataset"), "doc_id", value.alias("value"))
    ordered = rows.repartition("dataset").sortWithinPartitions("dataset", "doc_id")
    ordered.select("dataset", "value").write.partitionBy("dataset").text(path)
    return path


_JUNK = "(doc_id % 7 = 3 AND doc_id >= 100)"
_FOUND = "SELECT source AS dataset, doc_id, lang AS sheet, length(text) AS chars, md5(text) AS digest"
_WHOLE = f"{_FOUND} FROM documents WHERE NOT {_JUNK}"
_BEFORE_JUNK = f"""{_FOUND} FROM (SELECT *, min(CASE WHEN {_JUNK} THEN doc_id END) OVER (PARTITION BY source) AS first_bad FROM documents)
    WHERE doc_id < coalesce(first_bad, doc_id + 1)"""
_NOT_AFTER_JUNK = f"""{_FOUND} FROM (SELECT *, coalesce(lag({_JUNK}) OVER (PARTITION BY source ORDER BY doc_id), false) AS after_junk
    FROM documents) WHERE NOT {_JUNK} AND NOT after_junk"""


@query(_WHOLE)
def scan_lines_file(spark, sf_dir):
    return _read_back(spark, _broken(spark, sf_dir, "lines", pretty=False), "lines")


@query(_WHOLE)
def scan_auto_file(spark, sf_dir):
    return _read_back(spark, _broken(spark, sf_dir, "auto", pretty=False), "auto")


@query(_BEFORE_JUNK)
def scan_prefix_file(spark, sf_dir):
    return _read_back(spark, _broken(spark, sf_dir, "prefix", pretty=False), "prefix")


@query(_NOT_AFTER_JUNK)
def scan_pretty_file(spark, sf_dir):
    return _read_back(spark, _broken(spark, sf_dir, "pretty", pretty=True), "pretty")


@query(_NOT_AFTER_JUNK)
def scan_accumulate_file(spark, sf_dir):
    return _read_back(spark, _broken(spark, sf_dir, "accumulate", pretty=True), "accumulate")


@query(_WHOLE)
def scan_tolerant_file(spark, sf_dir):
    return _read_back(spark, _broken(spark, sf_dir, "tolerant", pretty=True), "tolerant")


@query(_ROUND_TRIP)
def record_roundtrip(spark, sf_dir):
    return _read_back(spark, _written(spark, sf_dir, "round-trip", pretty=True), "pretty")


@query(f"SELECT source AS dataset, count(*) AS rejects FROM documents WHERE {_JUNK} GROUP BY source")
def scan_rejected_lines(spark, sf_dir):
    rejects = other_lines(spark, _broken(spark, sf_dir, "rejects", pretty=False))
    return rejects.groupBy("dataset").agg(F.count(F.lit(1)).alias("rejects"))


@query("""SELECT doc_id AS ord, CASE WHEN lang <> 'de' THEN lang END AS lang, CASE WHEN lang <> 'de' THEN 'xx' END AS changed, source FROM documents""")
def json_paths(spark, sf_dir):
    """Values at dotted paths, read, and set where the path is there."""
    info = F.when(F.col("lang") != "de", F.struct("lang", "n_chars"))
    raw = F.to_json(F.struct("source", info.alias("info")))
    rows = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("ord"), raw.alias("raw"))
    rows = rows.withColumn("after", set_path(F.col("raw"), "info.lang", "xx"))
    return rows.select(
        "ord",
        get_path(F.col("raw"), "info.lang").alias("lang"),
        get_path(F.col("after"), "info.lang").alias("changed"),
        get_path(F.col("after"), "source").alias("source"),
    )


@query("SELECT c_custkey AS id, c_mktsegment AS set_code FROM customer WHERE c_custkey % 3 <> 0")
def card_payloads(spark, sf_dir):
    """Payload files of up to 500 cards each, read back as sets; every third card has none."""
    path = scratch_path(spark, "cards")
    sets = F.when(F.col("c_custkey") % 3 != 0, F.array(F.struct(F.col("c_mktsegment").alias("set_code"))))
    card = F.struct(F.col("c_custkey").alias("id"), sets.alias("card_sets"))
    payloads = table(spark, sf_dir, "customer").groupBy(F.floor(F.col("c_custkey") / 500)).agg(F.collect_list(card).alias("data"))
    payloads.select(F.to_json(F.struct("data"))).write.option("maxRecordsPerFile", 1).text(path)
    return flatten_sets(read_cards(spark, path))


@query(
    r"""SELECT p_partkey AS id, left(regexp_replace(regexp_replace(p_name || ' / ' || p_type, '[^\w\s-]', '', 'g'), '\s+', '_', 'g'), 30) AS part
        FROM part"""
)
def value_ids(spark, sf_dir):
    name = F.concat("p_name", F.lit(" / "), "p_type")
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), value_for_id(name).alias("part"))


@query(
    """SELECT 'dataset=' || source AS folder, true AS admitted, count(*) > 0 AS has_files FROM documents GROUP BY source"""
)
def file_listing(spark, sf_dir):
    path = _written(spark, sf_dir, "listing", pretty=False)
    files = outside_folder(distinct_files(list_files(spark, path, recursive=True)))
    return admit_by_size(files).groupBy("folder").agg(
        F.bool_and("admitted").alias("admitted"), (F.count(F.lit(1)) > 0).alias("has_files")
    )


@query("SELECT 'dataset=' || source AS folder, true AS filled FROM documents GROUP BY source")
def files_by_parent(spark, sf_dir):
    path = _written(spark, sf_dir, "parents", pretty=False)
    files = files_by_folder(list_files(spark, path, recursive=True))
    return files.select("folder", ((F.col("n_files") > 0) & (F.col("total_size") > 0)).alias("filled"))


@query(f"SELECT source AS dataset, {_FIELDS_SQL} AS text_fields FROM documents GROUP BY source")
def sidecar_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "sidecars")
    write_catalogues(field_catalogue(language_records(spark, sf_dir)), path)
    return read_catalogues(spark, path).withColumn("text_fields", F.array_join("text_fields", ","))


@query("SELECT source AS dataset, count(*) AS records, CAST(sum(length(text)) AS BIGINT) AS chars FROM documents GROUP BY source")
def flatten_folder(spark, sf_dir):
    from notewright.plans.corpus import trim_folder

    source, out = _written(spark, sf_dir, "flatten-in", pretty=True), scratch_path(spark, "flatten-out")
    trim_folder(spark, source, out, mode="pretty")
    return (
        read_records(spark, out, "lines")
        .groupBy("dataset")
        .agg(F.count(F.lit(1)).alias("records"), F.sum(F.length(F.col("text")["Text"])).alias("chars"))
    )


def _document_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as cards, their lines as sets; documents in German come without sets."""
    sets = F.transform(F.split("text", "\n"), lambda line: F.struct(line.alias("set_code")))
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"), F.when(F.col("lang") != "de", sets).alias("card_sets")
    )


@query("SELECT doc_id AS id, md5(unnest(string_split(text, chr(10)))) AS digest FROM documents WHERE lang <> 'de'")
def explode_nested(spark, sf_dir):
    return flatten_sets(_document_sets(spark, sf_dir)).select("id", F.md5("set_code").alias("digest"))


@query("SELECT p_partkey AS id, p_name AS name, p_brand AS brand FROM part")
def export_flat(spark, sf_dir):
    path = scratch_path(spark, "export")
    part = table(spark, sf_dir, "part")
    write_flat(part.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.col("p_brand").alias("brand")), path)
    return spark.read.schema("id bigint, name string, brand string").option("header", "true").csv(path)
