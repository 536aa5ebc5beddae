import random

import pytest
import rules
from pyspark.sql import functions as F

from notewright.functions import text as X
from notewright.functions.arguments import InvalidFields, clamp, preferred_fields, requested_fields, split_filters, within

CASES = [
    ("definition", "  A \t b\n c ", "A b c"),
    ("desc", "Hello  World", "hello world"),
    ("description", "Hello  World", "Hello World"),
    ("description", "a\u00a0b", "a\u00a0b"),
    ("definition", "a\u00a0b", "a b"),
    ("examples", "if x\n{\n    y  z\n\n}", "if x\n{\ny z\n}"),
    ("any", "=SUM(A1)", ""),
    ("any", "#REF!", ""),
    ("any", None, ""),
    ("any", "  \n", ""),
]


def random_cells(n=300):
    rng = random.Random(3)
    alphabet = list("aB=#") + list(X.WHITESPACE) + ["\n", " ", "é"]
    names = ["definition", "desc", "Description", "Examples", "code_snippet", "Returns"]
    return [(rng.choice(names), "".join(rng.choice(alphabet) for _ in range(rng.randrange(14)))) for _ in range(n)]


def test_cleaning_cases_and_random_cells(spark):
    rows = [(c, v, e) for c, v, e in CASES] + [(c, v, rules.clean(v, c)) for c, v in random_cells()]
    frame = spark.createDataFrame(rows, "name string, value string, expected string")
    by_column = frame.withColumn("got", X.clean_text(F.col("value"), F.col("name"))).collect()
    assert [r["got"] for r in by_column] == [r["expected"] for r in by_column]
    for name in {c for c, *_ in rows}:
        by_name = frame.filter(F.col("name") == name).withColumn("got", X.clean_text(F.col("value"), name)).collect()
        assert [r["got"] for r in by_name] == [r["expected"] for r in by_name]


def test_keep_indent(spark):
    frame = spark.createDataFrame([("if x\n{\n    y  z\n\n}",)], "v string")
    assert frame.select(X.clean_text(F.col("v"), "code", keep_indent=True)).first()[0] == "if x\n{\n    y z\n}"


@pytest.mark.parametrize(
    "raw, numeric, labeled",
    [("Name", False, True), (None, False, False), ("  ", False, False), ("Unnamed: 2", False, False),
     ("UNNAMED", False, False), ("-1", True, True), ("0", True, True), (" unnamed x", False, False)],
)
def test_labels(spark, raw, numeric, labeled):
    frame = spark.createDataFrame([(raw, numeric)], "h string, n boolean")
    assert frame.select(X.is_labeled(F.col("h"), F.col("n"))).first()[0] is labeled


def test_names(spark):
    def one(column):
        return spark.range(1).select(column).first()[0]

    lit = F.lit
    assert one(X.title_case(lit("first_name-of  (if any) ARGS"))) == "First Name Of (if Any) Args"
    assert one(X.snake_key(lit("File Name-x"))) == "file_name_x"
    assert one(X.normal_header(lit("-1.7"), lit(True))) == "-1"
    assert one(X.normal_header(lit(" a\u00a0"), lit(False))) == "a"
    names = {"A_references.xlsx": "A", "B.XLSX": "B", "C_references.xls": "C_references.xls", "_references": ""}
    for name, expected in names.items():
        assert one(X.workbook_id(lit(name))) == expected
    assert one(X.sheet_name_for_id(lit("Ab c!  (d)-é²" + "x" * 60))) == ("Ab_c_d-é²" + "x" * 60)[:50]
    assert one(X.value_for_id(lit("y" * 40))) == "y" * 30
    assert one(X.word_count(lit("a\u00a0b \x1c c\n"))) == 3
    assert one(X.ellipsis(lit("x" * 101), 100)) == "x" * 100 + "..."
    assert one(X.ellipsis(lit("x" * 100), 100)) == "x" * 100
    assert one(X.file_stem(lit("a/b.c/d.e.jsonl"))) == "d.e"
    assert one(X.parent_path(lit("a/b/c.x"))) == "a/b" and one(X.parent_path(lit("c.x"))) == ""


def test_argument_rules():
    text, meta = split_filters({"text.A": 1, "text.Z": "x", "sheet": "s", "page": 2}, ["A"], ["id", "sheet"])
    assert (text, meta) == ({"A": "1"}, {"sheet": "s"})
    assert requested_fields("A,B", ["A", "B"]) == ["A", "B"] and requested_fields("", ["A"]) is None
    with pytest.raises(InvalidFields) as error:
        requested_fields("A, B", ["A", "B"])
    assert error.value.invalid == [" B"] and error.value.available == ["A", "B"]
    assert clamp(0, 1, 50) == 1 and clamp(99, 1, 50) == 50
    with pytest.raises(ValueError):
        within("limit", 101, 1, 100)
    assert preferred_fields(["Function", "Definition", "Description"], ["Description", "Function"]) == ["Function", "Description"]
