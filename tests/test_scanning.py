import json
import random

import pytest
import rules
from pyspark.sql import functions as F

from notewright.functions.jsontext import is_json_object
from notewright.sources.jsonl import read_records, scan_lines, scan_objects, scan_rejects

RECORD = {"id": "A_b", "sheet": "S", "text": {"Function": "f{x}", "Examples": 'say "hi" {\n}\\'}, "metadata": {"row_index": 3}}


def line(i, **extra):
    return json.dumps({"id": f"r{i}", "sheet": "S", "text": {"K": f"v{i}"}, **extra})


CASES = {
    "bad_third_line": "\n".join([line(1), line(2), "{bad", line(4), line(5)]),
    "one_object": line(1),
    "adjacent": line(1) + line(2) + line(3),
    "pretty": "\n".join(json.dumps({**RECORD, "id": i}, indent=2, ensure_ascii=False) for i in range(4)) + "\n",
    "pretty_array": json.dumps([json.loads(line(1)), json.loads(line(2))], indent=2),
    "junk_first": "junk text\n" + line(1) + "\n" + line(2),
    "stray_brace": "}\n" + line(1),
    "crlf": "\r\n".join(json.dumps({**RECORD, "id": i}, indent=2) for i in range(3)),
    "blank_lines": "\n\n" + line(1) + "\n\n  \n" + line(2) + "\n",
    "open_string": line(1) + '\n{"a": "no end\n' + line(2) + "\n" + line(3),
    "non_objects": "1\n" + line(1) + '\n"text"\n' + line(2),
    "single_quotes": "{'a': 1}\n" + line(1),
    "odd_blanks": "\u00a0" + line(1) + "\x1c\n\u2003\n" + line(2),
    "trailing_junk": line(1) + " junk\n" + line(2),
}


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    root = tmp_path_factory.mktemp("cases")
    for name, content in CASES.items():
        (root / f"{name}.jsonl").write_text(content, encoding="utf-8", newline="")
    return root


def found(frame):
    out = {}
    for row in frame.orderBy("file_path", "ord").collect():
        out.setdefault(row["dataset"], []).append(json.loads(row["raw"]))
    return out


@pytest.mark.parametrize("mode", ["prefix", "lines", "accumulate", "tolerant"])
def test_modes_match_rules(spark, folder, mode):
    rule = {
        "prefix": rules.prefix,
        "lines": lambda c: rules.by_line(c, False),
        "accumulate": lambda c: rules.strung(c, False),
        "tolerant": lambda c: rules.strung(c, True),
    }[mode]
    got = found(scan_objects(spark, str(folder), mode))
    for name, content in CASES.items():
        assert got.get(name, []) == rule(content.replace("\r\n", "\n")), name


def test_auto_takes_lines_or_braces(spark, folder):
    got = found(scan_objects(spark, str(folder), "auto"))
    assert [r["id"] for r in got["bad_third_line"]] == ["r1", "r2", "r4", "r5"]
    assert [r["id"] for r in got["pretty_array"]] == ["r1", "r2"]
    assert [r["id"] for r in got["pretty"]] == [0, 1, 2, 3]


def test_pretty_without_python(spark, folder):
    for name, newline in (("pretty", "\n"), ("crlf", "\r\n")):
        frame = scan_objects(spark, str(folder / f"{name}.jsonl"), "pretty", newline=newline)
        assert found(frame)[name] == rules.strung(CASES[name].replace("\r\n", "\n"), True)
        assert "Python" not in frame._jdf.queryExecution().toString()


@pytest.fixture
def tiny_splits(spark):
    settings = {"maxPartitionBytes": "4096", "openCostInBytes": "0", "minPartitionNum": "1"}
    names = {f"spark.sql.files.{name}": value for name, value in settings.items()}
    before = {name: spark.conf.get(name, None) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        if value is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, value)


@pytest.mark.parametrize("mode", ["accumulate", "tolerant"])
@pytest.mark.parametrize("limit", [None, 0])
def test_objects_across_splits(spark, tiny_splits, tmp_path, mode, limit, monkeypatch):
    """Files cut into many splits give what one pass over the whole text gives."""
    if limit is not None:
        monkeypatch.setattr("notewright.sources.objects.is_small", lambda frame, rows: False)
    rng = random.Random(5)
    contents = {}
    for name in ("plain", "junk", "unbalanced", "stray"):
        parts = []
        for i in range(400):
            record = {"id": i, "text": {"a": "x" * rng.randrange(120), "b": rng.choice(['{"', "}", "\\", 'q"q', "é"])}}
            indent = rng.choice([None, 2])
            parts.append(json.dumps(record, indent=indent, ensure_ascii=False))
            if i == 3:
                parts.append(json.dumps({"id": "long", "text": {"a": ["y" * 50] * 400}}, indent=2))
            if name == "junk" and rng.random() < 0.1:
                parts.append("junk , [")
            if name == "unbalanced" and i == 250:
                parts.append('{"open": ')
            if name == "stray" and rng.random() < 0.01:
                parts.append("}")
            parts.append(rng.choice(["", "\n", "\n\n"]))
        contents[name] = "".join(parts)
        (tmp_path / f"{name}.jsonl").write_text(contents[name], encoding="utf-8")
    got = found(scan_objects(spark, str(tmp_path), mode))
    assert scan_lines(spark, str(tmp_path)).rdd.getNumPartitions() > 20
    for name, content in contents.items():
        assert got.get(name, []) == rules.strung(content, mode == "tolerant"), name


def test_line_order_is_unique_and_rising(spark, tiny_splits, tmp_path):
    lines = [line(i) for i in range(3000)]
    (tmp_path / "a.jsonl").write_text("\n".join(lines))
    rows = scan_lines(spark, str(tmp_path)).orderBy("ord").collect()
    assert [r["value"] for r in rows] == lines
    assert len({r["ord"] for r in rows}) == len(lines)


def test_splits_stay_the_same_in_a_session(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text(line(1))
    scan_lines(spark, str(tmp_path))
    assert spark.conf.get("spark.sql.files.minPartitionNum", None) is not None


def test_rejects(spark, folder):
    rows = scan_rejects(spark, str(folder / "bad_third_line.jsonl")).collect()
    assert [r["value"] for r in rows] == ["{bad"]


def test_record_parsing(spark, tmp_path):
    rows = [
        '{"id":"a","sheet":"S","text":{"Z":"1","A":"2","Z":"3"}}',
        '{"id":"b","sheet":null,"text":"plain"}',
        '{"id":7,"text":{"N":{"k":1},"E":""}}',
        '{"sheet":"x"}',
    ]
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "My notes+1.jsonl").write_text("\n".join(rows), encoding="utf-8")
    records = read_records(spark, str(tmp_path), "lines").withColumn("entries", F.map_entries("text"))
    got = records.orderBy("ord").collect()
    assert [r["dataset"] for r in got] == ["sub/My notes+1"] * 4
    assert [tuple(e) for e in got[0]["entries"]] == [("Z", "3"), ("A", "2")]
    assert got[1]["text"] is None and got[1]["has_text"] and got[1]["has_sheet"]
    assert got[2]["id"] == "7" and got[2]["text"] == {"N": '{"k":1}', "E": ""} and not got[2]["has_sheet"]
    assert not got[3]["has_id"] and not got[3]["has_text"]


def test_strict_object_check(spark):
    texts = ['{"a":1}', ' {"a":1} ', '{"a":1} x', '{"a":1}{', '{"a":1}]', '{"a":1},"b"', "{'a':1}", '{"a":"it\'s"}', "[1]", "1", "",
             '{"a":1,}', '{"a":"x\ty"}', '{"a":1,"a":2}', '{"a":"\\u00e9\\\\"}', None]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in frame.select(is_json_object(F.col("t"))).collect()]
    assert got == [t is not None and rules.is_object(t) for t in texts]
