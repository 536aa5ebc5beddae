import pytest
from pyspark.sql import functions as F

from notewright.operators.records import records_from_table
from notewright.operators.search import Dataset
from notewright.plans.store import open_store, trigrams, write_store

TEXTS = ["Red ring", "a blue 🙂ring bolt", None, "", "THE Ring of İstanbul", "ab", "Grünes Öl\nring", "50% off_ring", "zz" * 9000 + "needle"]
FIELDS = ["Other", "Text"]


@pytest.fixture(scope="module")
def both(spark, tmp_path_factory):
    """The same records as a store of small slabs and as a plain dataset."""
    rows = [(k, f"id{k % 4}", TEXTS[k % len(TEXTS)], f"other {k % 5} ring" if k % 3 == 0 else None) for k in range(90)]
    frame = spark.createDataFrame(rows, "key long, name string, text string, other string")
    records = records_from_table(frame, ["text", "other"], "key", F.col("name"), F.lit("s"), "t", clean=False)
    path = f"{tmp_path_factory.mktemp('store')}/s"
    write_store(records, path, "ord", slab_rows=8)
    return open_store(spark, path, "t", FIELDS, slab_rows=8), Dataset(records, "t", FIELDS)


def places(frame):
    return sorted(r["ord"] for r in frame.select("ord").collect())


NEEDLES = ["ring", "RING", "i", "in", "", "grün", "l\nr", "🙂r", "50%", "off_", "needle", "zzz", "nothing at all", "istan", "other 3", "xyz"]


@pytest.mark.parametrize("needle", NEEDLES)
def test_queries_and_filters_answer_as_the_scan(both, needle):
    store, plain = both
    assert places(store.matching(needle)) == places(plain.matching(needle))
    filters = {"text.Text": needle, "text.Other": "other", "sheet": "S", "unknown": "x"}
    assert places(store.matching("ring", filters)) == places(plain.matching("ring", filters))


@pytest.mark.parametrize("page", [1, 2, 5, 40])
def test_pages_and_totals(both, page):
    store, plain = both
    for query in (None, "ring"):
        assert store.page(page, 7, query=query).collect() == plain.page(page, 7, query=query).collect()
        assert store.page_info(7, query).collect() == plain.page_info(7, query).collect()


def test_lookup_and_first_records(both):
    store, plain = both
    for name in ("id0", "id3", "id9", ""):
        assert store.by_id(name).collect() == plain.by_id(name).collect()
    assert places(store.first_records()) == [0, 1, 2, 3] or len(places(store.first_records())) == 4


def test_only_the_slabs_needed_are_named_to_the_scan(both, capsys):
    store, _ = both
    for frame in (store.page(3, 8), store.by_id("id2"), store.matching("needle")):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(slab" in plan or "PartitionFilters: [slab" in plan
    found = store.candidates(["needle"])
    assert found.count() == 10 < store.records.count()


def test_a_needle_of_an_unknown_trigram_reads_no_record(both):
    store, _ = both
    assert store.candidates(["qqqq"]).isEmpty() and store.matching("qqqq").isEmpty()
    assert store.candidates(["in", ""]) is None


def test_many_slabs_fall_back_to_the_scan(both, monkeypatch):
    from notewright.plans import store as module

    store, plain = both
    monkeypatch.setattr(module, "MOST_SLABS", 2)
    assert places(store.matching("ring")) == places(plain.matching("ring"))


def test_a_store_without_postings(spark, tmp_path):
    frame = spark.createDataFrame([(1, "a", "some text")], "key long, name string, text string")
    records = records_from_table(frame, ["text"], "key", F.col("name"), F.lit("s"), "t", clean=False)
    write_store(records, f"{tmp_path}/s", "ord", grams=False)
    store = open_store(spark, f"{tmp_path}/s", "t", ["Text"], grams=False)
    assert store.matching("SOME").count() == 1


def test_trigrams(spark):
    got = spark.createDataFrame([("Ab cab c",), ("ab",), (None,), ("a\nb",)], "t string").select(trigrams(F.col("t")).alias("g")).collect()
    assert [r.g for r in got] == [["ab ", "b c", " ca", "cab"], [], None, ["a\nb"]]
