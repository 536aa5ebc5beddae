import pytest

from notewright.llm import decontaminate
from notewright.llm.queries import QUERIES

BENCHMARK = "item_id long, text string, doc_id string"


def runs(text, size):
    w = (text or "").lower().split()
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)}


def by_hand(texts, items):
    out = {}
    for i, item in items:
        size = min(5, len((item or "").split()))
        held = runs(item, size) if size else set()
        for d, text in texts if held else ():
            shared = len(held & runs(text, size))
            if shared * 10 >= len(held) * 8:
                out[d, i] = max(out.get((d, i), 0), shared / len(held))
    return out


def seq(a, b):
    return " ".join(f"w{k}" for k in range(a, b))


ITEMS = [
    (1, seq(0, 100)),
    (2, seq(200, 210)),
    (3, "short one"),
    (7, "What is two plus"),
    (8, "word9"),
    (4, None),
    (5, ""),
    (6, seq(0, 100)),
    (6, seq(500, 600)),
    (6, seq(500, 600)),
    (None, seq(900, 940)),
]
TEXTS = [
    None,
    "",
    "short one",
    "a short one here",
    "before what IS two\nplus after " + " ".join(f"v{k}" for k in range(300)),
    "what is two",
    "word9 and more",
    "X " + seq(0, 100) + " " + seq(1000, 9000),
    seq(0, 85) + " " + seq(3000, 3100),
    seq(0, 80) + " " + seq(3000, 3100),
    seq(5, 48) + " x " + seq(49, 100),
    seq(200, 210).upper(),
    seq(500, 600),
    seq(500, 600),
    seq(900, 940),
    seq(200, 208),
    " ".join([seq(200, 210)] * 3000),
]


def test_odd_texts(spark, docs_of):
    benchmark = spark.createDataFrame([(i, t, "x") for i, t in ITEMS], BENCHMARK)
    docs = docs_of(TEXTS)
    got = {(r.doc_id, r.item_id): r.containment for r in decontaminate.contaminated(docs, benchmark).collect()}
    assert got == pytest.approx(by_hand(list(enumerate(TEXTS)), ITEMS))
    kept = {r.doc_id for r in decontaminate.clean(docs, benchmark).collect()}
    assert kept == set(range(len(TEXTS))) - {d for d, _ in got}


def test_query_on_table(spark, small_sf):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small_sf}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{small_sf}/benchmark.parquet").collect()]
    got = {(r.doc_id, r.item_id): r.containment for r in QUERIES["op6_decontamination"](spark, small_sf).collect()}
    assert got and got == pytest.approx(by_hand(texts, items))


def test_empty_tables(spark, docs_of):
    none = spark.createDataFrame([], BENCHMARK)
    some = spark.createDataFrame([(1, seq(0, 9), "")], BENCHMARK)
    assert decontaminate.contaminated(docs_of([seq(0, 9)]), none).count() == 0
    assert decontaminate.contaminated(docs_of([]), some).count() == 0
    assert decontaminate.clean(docs_of([seq(0, 9), "a"]), some).count() == 1


def test_columns_of_any_name_stay(spark, docs_of):
    docs = docs_of([seq(0, 9), "a"]).selectExpr("*", "doc_id + 7 as __blob", "'x' as blob", "1 as `odd.name`")
    some = spark.createDataFrame([(1, seq(0, 9), "")], BENCHMARK)
    assert [r.asDict() for r in decontaminate.clean(docs, some).collect()] == [docs.filter("doc_id = 1").first().asDict()]


def test_sql_with_short_items(spark, docs_of, sf_of):
    import compare

    from notewright.llm.queries import SQL
    from notewright.plans.registry import Query

    benchmark = spark.createDataFrame([(k, t, "x") for k, (_, t) in enumerate(ITEMS)], BENCHMARK)
    folder = sf_of(documents=docs_of(TEXTS), benchmark=benchmark)
    connection = __import__("duckdb").connect()
    for name in ("documents", "benchmark"):
        connection.sql(f"create view {name} as from read_parquet('{folder}/{name}.parquet/*.parquet')")
    each = Query("op6", QUERIES["op6_decontamination"], SQL["op6_decontamination"])
    assert compare.difference(spark, connection, each, folder) is None


def test_bound_on_hits():
    assert decontaminate.least_hits(32) == 12 or decontaminate.least_hits(32) > 8
