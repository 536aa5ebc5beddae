"""Jobs run on workers that cannot import the library: only what travels with the job is there."""

import os
import subprocess
import sys
from pathlib import Path

_SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
import __spark_entry__ as entry
from notewright.session import build_session

spark = build_session("local[2]", spark__sql__shuffle__partitions="2", spark__ui__enabled="false",
    spark__sql__warehouse__dir={warehouse!r}, spark__driver__host="127.0.0.1")
spark.sparkContext.setLogLevel("OFF")

def absent(batches):
    import importlib.util
    for batch in batches:
        import pyarrow as pa
        found = importlib.util.find_spec("notewright") is not None
        yield pa.RecordBatch.from_arrays([pa.array([found] * batch.num_rows)], names=["found"])

assert not spark.range(1).mapInArrow(absent, "found boolean").first()[0], "the worker sees the library"
for name in {names!r}:
    print(name, entry.queries()[name](spark, {folder!r}).count() > 0)
"""


def run_elsewhere(tmp_path, folder, names):
    """Run the queries from a folder without the library; every one must give rows."""
    repo = str(Path(__file__).resolve().parent.parent)
    script = tmp_path / "run.py"
    script.write_text(_SCRIPT.format(repo=repo, warehouse=str(tmp_path / "wh"), names=names, folder=folder))
    paths = [p for p in os.environ.get("PYTHONPATH", "").split(":") if p and not (Path(p) / "notewright").exists()]
    env = os.environ | {"PYTHONPATH": ":".join(paths)}
    done = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=400)
    assert done.returncode == 0, done.stderr[-3000:]
    assert done.stdout.split() == [word for name in names for word in (name, "True")]


def test_from_another_folder(small_sf, tmp_path):
    run_elsewhere(tmp_path, small_sf, ["embed_batch", "vector_roundtrip", "embed_folder_set", "workbook_cells", "knn_batch"])
