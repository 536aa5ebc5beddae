import pytest
from books import Date, Error, write_book
from pyspark.sql import functions as F

from notewright import convert_workbooks, load_dataset, read_workbooks, records_of_pattern
from notewright.operators.census import pattern_sheets, rank_patterns, sheets_like
from notewright.operators.catalogue import field_catalogue
from notewright.operators.stats import data_overview, length_statistics
from notewright.sinks.records import write_catalogues
from notewright.sources.jsonl import read_records
from notewright.sources.workbook import HEADER_ROW


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    root = tmp_path_factory.mktemp("books")
    write_book(
        root / "A_references.xlsx",
        {
            "Main": [
                ["first name", "first_name", None, "Unnamed: 2", "  ", -1, 0, "File Name", "description"],
                ["x", "y", "dropped", "dropped", "dropped", 1.5, 2, "doc", "  Keep\n\n  lines  here "],
                [],
                ["=A1", "N/A", "still dropped", None, None, Error("#REF!"), None, None, "#DIV/0!"],
                ["one  two", None, None, None, None, 3.0, True, Date(45292), "inline:a <b>"],
            ],
            "Other": [["Function", "Returns"], ["f()", "int"], ["g()", None]],
            "Empty": [],
        },
    )
    write_book(root / "B.XLSX", {"S1": [["Function", "Returns"], ["h()", "bool"]], "S2": [["Returns", "Function"], ["r", "f"]]})
    (root / "broken.xlsx").write_bytes(b"not a zip")
    (root / "~$A_references.xlsx").write_bytes(b"lock")
    (root / "notes.txt").write_text("x")
    return str(root)


@pytest.fixture(scope="module")
def corpus(spark, folder):
    return read_workbooks(spark, folder)


def test_headers(corpus):
    rows = {(r["file_name"], r["sheet"]): r for r in corpus.sheets.collect()}
    main = rows["A_references.xlsx", "Main"]
    assert main["columns"] == ["first name", "first_name", "-1", "0", "File Name", "description"]
    assert main["unlabeled"] == 3
    assert rows["A_references.xlsx", "Empty"]["columns"] == []
    assert rows["B.XLSX", "S2"]["columns"] == ["Returns", "Function"]


def test_records(corpus):
    rows = corpus.records.filter("sheet = 'Main'").orderBy("ord").collect()
    assert [r["metadata"]["row_index"] for r in rows] == [0, 3]  # the blank row counts, the empty one is dropped
    first, last = rows
    assert first["id"] == "A" and first["metadata"]["file_name"] == "A_references.xlsx"
    assert first["text"] == {
        "First Name": "y", "1": "1.5", "0": "2", "File Name": "doc", "Description": "Keep\nlines here",
    }
    assert first["metadata"]["non_empty_columns"] == 6 and first["metadata"]["total_labeled_columns"] == 6
    assert first["metadata"]["columns_used"] == ["first name", "first_name", "-1", "0", "File Name", "description"]
    assert first["metadata"]["text_length"] == sum(len(v) for v in first["text"].values())
    assert first["metadata"]["word_count"] == sum(len(v.split()) for v in first["text"].values())
    assert first["columns"]["file_name"] == "doc" and first["columns"]["_1"] == "1.5"
    assert last["text"] == {
        "First Name": "one two", "1": "3", "0": "True", "File Name": "2024-01-01 00:00:00", "Description": "a <b>",
    }
    assert last["columns"]["first_name"] is None  # two headers share the key, the last one is empty


def test_key_order(corpus):
    keys = corpus.records.filter("sheet = 'Main'").orderBy("ord").select(F.map_keys("text")).first()[0]
    assert keys == ["First Name", "1", "0", "File Name", "Description"]


def test_patterns(spark, corpus, folder):
    ranks = corpus.patterns.orderBy("rank").collect()
    assert [(r["rank"], r["labels"], r["count"]) for r in ranks][0] == (1, ["Function", "Returns"], 2)
    assert [r["rank"] for r in ranks] == [1, 2, 3, 4] and {r["count"] for r in ranks[1:]} == {1}
    assert [] in [r["labels"] for r in ranks]
    sheets = pattern_sheets(corpus.sheets, rank_patterns(corpus.sheets)).filter("rank = 1")
    assert {(r["file_name"], r["sheet"]) for r in sheets.collect()} == {("A_references.xlsx", "Other"), ("B.XLSX", "S1")}
    assert sheets_like(corpus.sheets, ["Returns", "Function"]).count() == 1
    assert sheets_like(corpus.sheets, []).count() == 1 and sheets_like(corpus.sheets, ["first name", "first_name", -1, 0.0, "File Name", "description"]).count() == 1
    found = records_of_pattern(corpus, ["Function", "Returns"]).collect()
    assert {r["text"]["Function"] for r in found} == {"f()", "g()", "h()"}


def test_rejects_and_tally(spark, corpus, folder):
    assert [r["file_name"] for r in corpus.rejects.collect()] == ["broken.xlsx"]
    small = read_workbooks(spark, folder, max_mb=0.0001)
    reasons = {r["file_name"]: r["reason"] for r in small.rejects.collect()}
    assert reasons["B.XLSX"].startswith("File too large")
    tally = {(r["file_name"], r["sheet"]): r for r in corpus.tally.collect()}
    main = tally["A_references.xlsx", "Main"]
    assert (main["rows_read"], main["rows_written"], main["rows_skipped"], main["unlabeled"]) == (3, 2, 1, 3)
    assert tally["A_references.xlsx", "Empty"]["rows_read"] == 0
    assert corpus.cells.filter(F.col("row_index") == HEADER_ROW).count() == 5


def test_convert_catalogue_and_load(spark, folder, tmp_path):
    out, catalogues = str(tmp_path / "out"), str(tmp_path / "catalogues")
    corpus = convert_workbooks(spark, folder, out)
    back = read_records(spark, out, "pretty")
    assert back.count() == corpus.records.count() == 6
    want = {(r["id"], r["sheet"], str(sorted(r["text"].items()))) for r in corpus.records.collect()}
    assert {(r["id"], r["sheet"], str(sorted(r["text"].items()))) for r in back.collect()} == want
    assert {r["dataset"] for r in back.select("dataset").distinct().collect()} == {"A", "B"}
    written = {str(sorted(r["columns"].items(), key=str)) for r in corpus.records.collect()}
    assert {str(sorted(r["columns"].items(), key=str)) for r in back.collect()} == written
    write_catalogues(field_catalogue(back), catalogues)
    stats = length_statistics(back, F.col("metadata.text_length")).first()
    lengths = sorted(r["metadata"]["text_length"] for r in back.collect())
    assert stats["median_text_length"] == (lengths[2] + lengths[3]) / 2 and stats["total_characters"] == sum(lengths)
    overview = data_overview(back, F.col("metadata.file_name"), F.col("sheet")).first()
    assert (overview["total_files"], overview["total_sheets"], overview["total_records"]) == (2, 4, 6)


def test_load_dataset_needs_its_catalogue(spark, tmp_path):
    (tmp_path / "N_text.jsonl").write_text(
        '{"id":"N","sheet":"S","text":{"Function":"abc","Returns":"int"}}\n{"id":"M","sheet":"T","text":{"Function":"Abd"}}\n'
    )
    with pytest.raises(FileNotFoundError):
        load_dataset(spark, str(tmp_path), "N_text")
    (tmp_path / "N_text_texted.txt").write_text('{"text": {"text_fields": ["Function", "Returns"]}}')
    data = load_dataset(spark, str(tmp_path), "N_text")
    assert data.text_fields == ["Function", "Returns"] and data.page_info().first()["total"] == 2
    (tmp_path / "Odd_text.jsonl").write_text(
        '{"id":"N","sheet":"S","text":{"A":"x"},"category":"Blue","metadata":{"row_index":1,"first_name":"Ann"},"n":[1]}\n'
        '{"id":"M","sheet":"S","text":{"A":"y"},"category":"red"}\n'
    )
    (tmp_path / "Odd_text_texted.txt").write_text('{"text": {"text_fields": ["A"]}}')
    odd = load_dataset(spark, str(tmp_path), "Odd_text")
    assert set(odd.metadata_fields) == {"id", "sheet", "metadata", "category", "n", "metadata.first_name"}
    assert [r["id"] for r in odd.search(filters={"category": "BLUE"}).collect()] == ["N"]
    assert odd.search(filters={"metadata.first_name": "ann"}).first()["metadata"]["category"] == "Blue"
    rows = data.search("AB", {"text.Returns": "in"}).collect()
    assert [r["id"] for r in rows] == ["N"] and rows[0]["text"] == {"Function": "abc", "Returns": "int"}
    assert data.search("metadata").count() == 0
    with pytest.raises(ValueError):
        data.search(fields=["Nope"])
    with pytest.raises(ValueError):
        data.page(page=0)
    assert data.by_id("M").first()["text"] == {"Function": "Abd"} and data.by_id("m").count() == 0
    assert [r["id"] for r in data.id_pattern("n").collect()] == ["N"]
    assert data.page(2, 1).first()["id"] == "M" and data.page(3, 1).count() == 0
