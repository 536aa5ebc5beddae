import json

import pytest
import rules
from pyspark.sql import functions as F

from notewright.operators.catalogue import (
    child_keys,
    compare_datasets,
    dataset_status,
    field_catalogue,
    nested_key_paths,
    record_counts,
)
from notewright.operators.numbering import number_files, number_rows, number_sorted, running_total
from notewright.operators.records import records_from_table, trim_objects, trim_rejects
from notewright.operators.rewrite import replace_tally, rewrite_objects, set_path
from notewright.operators.search import Dataset, first_per_id, page_rows
from notewright.operators.sizing import join_measured
from notewright.plans.corpus import catalogue_folder, load_dataset, rewrite_folder, trim_folder
from notewright.sinks.records import write_compact
from notewright.sources.catalogue_files import catalogue_fields, read_catalogues
from notewright.sources.jsonl import parse_records, read_records


def objects(spark, values):
    rows = [("d", i, v if isinstance(v, str) else json.dumps(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "dataset string, ord bigint, raw string")


def test_key_paths(spark):
    values = [
        {"a": {"b": {"c": 1}, "x.y": {"`q`": None}}, "l": [{"no": 1}]},
        {"a": "text", "z": {"": {"deep": {}}}, "k: <v>, {w}": {"m": [1], "n": 1.5}},
        '{"a":{"p":1},"a":{"r":{"s":2}}}',
        [{"skip": 1}],
    ]
    got = {r["path"] for r in nested_key_paths(objects(spark, values)).collect()}
    expected = set()

    def walk(node, prefix):
        for key, value in node.items():
            expected.add(prefix + key)
            if isinstance(value, dict):
                walk(value, f"{prefix}{key}.")

    for value in values:
        value = json.loads(value) if isinstance(value, str) else value
        if isinstance(value, dict):
            walk(value, "")
    assert got == expected
    assert {r["key"] for r in child_keys(objects(spark, values), "a").collect()} == {"b", "x.y", "r"}
    assert {r["key"] for r in child_keys(objects(spark, values), "a.b").collect()} == {"c"}
    assert child_keys(objects(spark, ['{"a":"{\\"no\\":1}"}']), "a").count() == 0


def test_catalogue_counts_and_comparison(spark):
    values = [
        {"id": "1", "text": {"b": "x", "é": "y", "A": "z"}},
        {"id": "2", "text": "none"},
        {"id": "3"},
        {"id": "4", "text": {"b": "w"}},
    ]
    records = parse_records(objects(spark, values))
    assert field_catalogue(records).first()["text_fields"] == ["A", "b", "é"]
    counts = {r["dataset"]: (r["total"], r["valid"], r["failed"]) for r in record_counts(records, grand_total=True).collect()}
    assert counts == {"d": (4, 2, 2), None: (4, 2, 2)}
    row = compare_datasets(records).first()
    assert (row["records"], row["fields"]) == (4, 3)


def test_trim_and_salvage(spark):
    values = [
        {"metadata": {"x": 1}, "text": {"b": 1, "a": None, "n": {"z": 1, "y": [1, 2]}}, "sheet": None, "id": "é"},
        {"id": "a", "sheet": "b"},
        '{"id": "q\\"1", "sheet": "s", "text": {"k": "v } {", "m": {"n": "o"}}, "metadata": {bad}',
        '{"id": "a", "sheet": 5, "text": {bad}',
        '{"id": "m",\n "sheet": "s",\n "text": {\n  "k": "a\\nb"\n },\n "metadata": {bad}',
        {"id": 5, "sheet": "s", "text": "plain \"text\""},
    ]
    rows = trim_objects(objects(spark, values)).orderBy("ord").collect()
    got = {r["ord"]: json.loads(r["trimmed"]) for r in rows}
    assert got == {
        0: {"id": "é", "sheet": None, "text": {"b": 1, "a": None, "n": {"z": 1, "y": [1, 2]}}},
        2: {"id": 'q"1', "sheet": "s", "text": {"k": "v } {", "m": {"n": "o"}}},
        4: {"id": "m", "sheet": "s", "text": {"k": "a\nb"}},
        5: {"id": 5, "sheet": "s", "text": 'plain "text"'},
    }
    assert all("\n" not in r["trimmed"] for r in rows)
    assert rows[0]["trimmed"].startswith('{"id":"é","sheet":null,"text":{"b":1,"a":null,')


def test_rewrite_rules(spark):
    values = [
        {"text": {"Function": "teh teh", "n": {"Function": "teh"}}, "Function": ["teh"]},
        {"text": {"Function": 5}, "list": [{"Function": "a teh b"}, [{"Function": "x"}]]},
        {"Function": {"Function": "teh"}},
        {"text": {"Function": "TEH"}},
        {"text": {"Function": "café teh"}},
        {"other": "teh"},
    ]
    for key in ("Function", "text.Function", "text.n.Function", "text.missing.x"):
        frame = rewrite_objects(objects(spark, values), key, "teh", "the")
        for row in frame.collect():
            want, changed = rules.replace(values[row["ord"]], key, "teh", "the")
            assert json.loads(row["raw"]) == want and row["changed"] == changed, (key, row)
    tally = replace_tally(rewrite_objects(objects(spark, values), "Function", "teh", "the"), grand_total=True)
    assert {(r["dataset"], r["objects"], r["changes"], r["files_modified"]) for r in tally.collect()} == {
        ("d", 6, 3, 1), (None, 6, 3, 1),
    }


def test_salvage_of_deep_objects_and_rejects(spark):
    deep = '{"a":' * 800 + r'"1 } \" {"' + "}" * 800
    rows = objects(spark, ['{"id":"A","sheet":"S","text":' + deep + ",,}", "neither", {"id": "B", "sheet": "S", "text": {}}])
    found = trim_objects(rows).orderBy("ord").collect()
    assert [json.loads(r["trimmed"])["id"] for r in found] == ["A", "B"] and json.loads(found[0]["trimmed"])["text"] == json.loads(deep)
    assert [r["raw"] for r in trim_rejects(rows).collect()] == ["neither"]


def test_rewrite_finds_escaped_text(spark):
    raw = '{"k":"caf\\u00e9 \\"q\\""}'
    row = rewrite_objects(objects(spark, [raw]), "k", 'é "q"', "!").first()
    assert row["changed"] and json.loads(row["raw"]) == {"k": "caf!"}


def test_folder_jobs(spark, tmp_path):
    source = tmp_path / "in"
    (source / "sub").mkdir(parents=True)
    record = {"id": "A", "sheet": "S", "text": {"Function": "teh one"}, "metadata": {"row_index": 1}}
    (source / "a.jsonl").write_text(json.dumps(record, indent=2) + "\n" + json.dumps({**record, "id": "B"}, indent=2))
    (source / "sub" / "a.jsonl").write_text(json.dumps({**record, "text": {"Other": "x"}}) + "\n")
    out = str(tmp_path / "trim")
    trim_folder(spark, str(source), out)
    back = read_records(spark, out, "lines").orderBy("dataset", "ord").collect()
    assert [(r["dataset"], r["id"]) for r in back] == [("a", "A"), ("a", "B"), ("sub/a", "A")]
    assert back[0]["metadata"] is None
    catalogue_folder(spark, out, str(tmp_path / "cat"))
    catalogues = read_catalogues(spark, str(tmp_path / "cat"))
    assert catalogue_fields(catalogues, "sub/a") == ["Other"]
    nested = load_dataset(spark, out, "sub/a", str(tmp_path / "cat"))
    assert nested.page_info().first()["total"] == 1 and nested.search("x").first()["text"] == {"Other": "x"}
    tally = rewrite_folder(spark, str(source), str(tmp_path / "fixed"), "text.Function", "teh", "the")
    assert {(r["dataset"], r["changes"]) for r in tally.collect()} == {("a", 2), ("sub/a", 0), (None, 2)}
    fixed = read_records(spark, str(tmp_path / "fixed"), "lines").orderBy("dataset", "ord").collect()
    assert [r["text"] for r in fixed] == [{"Function": "the one"}] * 2 + [{"Other": "x"}]
    (source / "b.jsonl").write_text(json.dumps(record) + "\nnot json teh\n17\n")
    rewrite_folder(spark, str(source), str(tmp_path / "again"), "text.Function", "teh", "the")
    lines = spark.read.text(str(tmp_path / "again") + "/dataset=b").collect()
    assert [r["value"][:12] for r in lines][1:] == ["not json teh", "17"] and '"the one"' in lines[0]["value"]
    assert json.loads((source / "a.jsonl").read_text().split("\n}\n")[0] + "}") == record  # input untouched


def test_part_files_follow_record_order(spark, tmp_path):
    rows = [("hot" if i % 3 else f"d{i % 5}", i, f"r{i}", "S", {"K": str(i)}) for i in range(500)]
    frame = spark.createDataFrame(rows, "dataset string, ord bigint, id string, sheet string, text map<string,string>")
    write_compact(frame.repartition(9), str(tmp_path / "out"))
    back = read_records(spark, str(tmp_path / "out"), "lines").orderBy("dataset", "file_path", "ord").collect()
    assert [r["id"] for r in back if r["dataset"] == "hot"] == [i for d, _, i, _, _ in rows if d == "hot"]
    assert {(r["dataset"], r["id"], r["text"]["K"]) for r in back} == {(d, i, t["K"]) for d, _, i, _, t in rows} and len(back) == 500
    assert len(list((tmp_path / "out").rglob("part-*"))) < 9 * 6


def test_dataset_in_several_part_files(spark, tmp_path):
    rows = [("d", i, f"r{i % 90}", "S", {"K": str(i)}) for i in range(400)]
    frame = spark.createDataFrame(rows, "dataset string, ord bigint, id string, sheet string, text map<string,string>")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_compact(frame.repartition(7), str(tmp_path / "out"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    catalogue_folder(spark, str(tmp_path / "out"), str(tmp_path / "cat"))
    dataset = load_dataset(spark, str(tmp_path / "out"), "d", str(tmp_path / "cat"))
    assert dataset.records.select("file_path").distinct().count() > 1
    paged = [r["text"]["K"] for page in range(1, 41) for r in dataset.page(page, 10).collect()]
    assert paged == [str(i) for i in range(400)]
    firsts = first_per_id(dataset.records, dataset.order).collect()
    assert sorted(int(r["text"]["K"]) for r in firsts) == list(range(90))
    (status,) = dataset_status(dataset.records, order=dataset.order).collect()
    assert status["total_records"] == 400 and status["sample_record"]["text"] == {"K": "0"}
    deep = page_rows(dataset.records, dataset.order, 395, 10**6, chunk_bits=3).collect()
    assert [r["text"]["K"] for r in deep] == [str(i) for i in range(395, 400)]


def test_set_path(spark):
    frame = objects(spark, [{"a": {"k": 1, "j": 2}}, {"b": "x"}, {"a": {"j": 3}}])
    rows = frame.select("ord", set_path(F.col("raw"), "a.k", "n").alias("raw")).orderBy("ord").collect()
    assert [json.loads(r["raw"]) for r in rows] == [{"a": {"k": "n", "j": 2}}, {"b": "x"}, {"a": {"j": 3}}]


def test_numbering(spark):
    rows = [(f"f{i % 3 if i % 5 else 0}", i * 7, i % 4 != 0) for i in range(500)]
    frame = spark.createDataFrame(rows, "file string, ord bigint, keep boolean").repartition(7)
    numbered = number_rows(frame, ["file"], "ord", "at", chunk_bits=5).collect()
    expected = {}
    for file, order, _ in sorted(rows):
        expected[file, order] = sum(1 for f, o, _ in rows if f == file and o < order)
    assert {(r["file"], r["ord"]): r["at"] for r in numbered} == expected
    kept = number_files(frame, "file", "ord", F.col("keep"), chunk_bits=5).collect()
    want = [(f, o) for f, o, k in sorted(rows) if k]
    assert {(r["file"], r["ord"]): (r["local_index"], r["global_index"]) for r in kept} == {
        key: (expected[key], i) for i, key in enumerate(want)
    }
    ordered = number_sorted(frame, [F.desc("file"), "ord"], "at").collect()
    by_rule = sorted(rows, key=lambda r: r[1])
    by_rule.sort(key=lambda r: r[0], reverse=True)
    assert [(r["file"], r["ord"]) for r in sorted(ordered, key=lambda r: r["at"])] == [(f, o) for f, o, _ in by_rule]
    totals = {r["ord"]: r["before"] for r in running_total(frame, ["ord"], "ord", "before").collect()}
    assert totals == {o: sum(x for _, x, _ in rows if x < o) for _, o, _ in rows}


def test_join_measured_beyond_the_bound(spark):
    big = spark.range(3000).select((F.col("id") % 10).alias("k"), "id").withColumn("k", F.when(F.col("id") < 1000, 3).otherwise(F.col("k")))
    small = spark.range(8).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    for how in ("inner", "left", "left_semi", "left_anti"):
        plain = sorted(map(tuple, big.join(small, "k", how).collect()), key=str)
        for hot_rows, skewed in ((500, True), (10**6, True), (10**6, False)):
            other = join_measured(big, small, "k", how, max_rows=3, hot_rows=hot_rows, skewed=skewed)
            assert sorted(map(tuple, other.select(*big.join(small, "k", how).columns).collect()), key=str) == plain
            assert "SortMergeJoin" in other._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("bits", [2, 6, 17])
def test_deep_page_equals_shallow_page(spark, monkeypatch, bits):
    frame = spark.range(400).select((F.col("id") * 3).alias("ord")).repartition(5)
    shallow = [r["ord"] for r in page_rows(frame, "ord", 120, 10).collect()]
    monkeypatch.setattr("notewright.operators.search.SHALLOW_ROWS", 50)
    deep = page_rows(frame, "ord", 120, 10, bits)
    assert [r["ord"] for r in deep.collect()] == shallow == [3 * i for i in range(120, 130)]
    assert [r["ord"] for r in page_rows(frame, "ord", 395, 10, bits).collect()] == [3 * i for i in range(395, 400)]
    assert page_rows(frame, "ord", 400, 10, bits).count() == 0


def test_search_stays_in_the_jvm(spark, small_sf):
    documents = spark.read.parquet(f"{small_sf}/documents.parquet")
    records = records_from_table(documents, ["text"], "doc_id", F.col("source"), F.col("lang"), "documents", clean=False)
    data = Dataset(records, "documents", ["Text"])
    plan = data.search("the", {"sheet": "en"})._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "Python" not in plan and "Exchange" not in plan
    plan = data.full_record("src7")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(source,src7)" in plan
