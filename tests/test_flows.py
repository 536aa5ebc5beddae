import importlib.util
import json
import sys
from pathlib import Path

import compare
import pytest
from pyspark.sql import functions as F

from notewright.plans.registry import load_register
from notewright.session import scratch_path, shared_dir
from notewright.sinks.records import write_flat
from notewright.sources.files import admit_by_size, files_by_folder, list_files, outside_folder, require_files
from notewright.sources.nested import flatten_sets, read_cards
from notewright.streaming.landing import append_records, stream_records

ROOT = Path(__file__).resolve().parent.parent


@pytest.fixture(scope="module")
def duck(small_sf):
    pytest.importorskip("duckdb")
    return compare.connect(small_sf)


@pytest.mark.parametrize("name", sorted(load_register()))
def test_query_equals_its_sql(spark, duck, small_sf, name):
    assert compare.difference(spark, duck, load_register()[name], small_sf) is None


def test_entry_points(spark, small_sf):
    spec = importlib.util.spec_from_file_location("entry_points", ROOT / "__spark_entry__.py")
    module = importlib.util.module_from_spec(spec)
    sys.modules["entry_points"] = module
    spec.loader.exec_module(module)
    assert module.entry(spark).count() == 20
    assert set(module.oracle_sql()) <= set(module.queries())


def test_listing(spark, tmp_path):
    (tmp_path / "sub dir").mkdir()
    (tmp_path / "_text").mkdir()
    for name in ("b.jsonl", "a.jsonl", "c.txt", "sub dir/d+1.jsonl", "~$x.jsonl", ".h.jsonl", "_text/e.jsonl"):
        (tmp_path / name).write_text("x" * 10)
    flat = list_files(spark, str(tmp_path))
    assert {r["file_name"] for r in flat.collect()} == {"a.jsonl", "b.jsonl"}
    both = list_files(spark, str(tmp_path), "*.{jsonl,txt}")
    assert {r["file_name"] for r in both.collect()} == {"a.jsonl", "b.jsonl", "c.txt"}
    deep = outside_folder(list_files(spark, str(tmp_path), recursive=True))
    assert {(r["folder"], r["relative_path"]) for r in deep.collect()} == {
        ("", "a.jsonl"), ("", "b.jsonl"), ("sub dir", "sub dir/d+1.jsonl"),
    }
    assert {(r["folder"], r["n_files"]) for r in files_by_folder(deep).collect()} == {("", 2), ("sub dir", 1)}
    admitted = admit_by_size(flat, max_mb=0.000001).collect()
    assert all(not r["admitted"] and "too large" in r["reason"] for r in admitted)
    with pytest.raises(FileNotFoundError):
        require_files(list_files(spark, str(tmp_path), "*.none"), str(tmp_path))


def test_cards(spark, tmp_path):
    payload = {"data": [{"id": 1, "card_sets": [{"set_code": "A"}, {"set_code": "A"}]}, {"id": 2}, {"id": 3, "card_sets": []}]}
    (tmp_path / "cards.json").write_text(json.dumps(payload, indent=2))
    flat = flatten_sets(read_cards(spark, str(tmp_path / "cards.json")))
    assert [tuple(r) for r in flat.collect()] == [(1, "A"), (1, "A")]
    write_flat(flat, str(tmp_path / "out"))
    assert spark.read.csv(str(tmp_path / "out"), header=True).count() == 2


@pytest.mark.parametrize("pretty", [False, True])
def test_landing_folder(spark, tmp_path, pretty):
    landing, out, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "checkpoint")
    landing.mkdir()

    def land(name, ids):
        records = [{"id": i, "sheet": "S", "text": {"K": "v"}} for i in ids]
        (landing / name).write_text("\n".join(json.dumps(r, indent=2 if pretty else None) for r in records) + ("" if pretty else "\n{bad\n"))

    land("a.jsonl", ["1", "2"])
    append_records(stream_records(spark, str(landing), pretty=pretty), out, checkpoint).awaitTermination()
    land("b.jsonl", ["3"])
    append_records(stream_records(spark, str(landing), pretty=pretty), out, checkpoint).awaitTermination()
    rows = spark.read.parquet(out).select("dataset", "id", F.col("text")["K"].alias("k")).collect()
    assert sorted(map(tuple, rows)) == [("a", "1", "v"), ("a", "2", "v"), ("b", "3", "v")]


def test_shared_folder_comes_from_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    folder = shared_dir(spark)
    assert folder == (named or folder).rstrip("/") and spark.sparkContext.getCheckpointDir()
    assert scratch_path(spark, "x").startswith(folder) and scratch_path(spark, "x") != scratch_path(spark, "x")
