"""Each stage against a brute-force version of it on the stage's own input."""

import pytest

import corpus_pipeline
from notewright.llm import quality
from tests.llm import test_decontaminate, test_packing, test_pii
from tests.llm.test_packing import encoders  # noqa: F401


@pytest.fixture(scope="module")
def stages(spark, small_sf, tmp_path_factory):
    """Rows before and after each stage, by its name."""
    docs = spark.read.parquet(f"{small_sf}/documents.parquet")
    out, top = {}, tmp_path_factory.mktemp("stages")
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        result = stage(spark, docs, small_sf)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert result.columns == docs.columns
        result.write.parquet(f"{top}/{k}")
        after = spark.read.parquet(f"{top}/{k}")
        out[name] = (docs.collect(), after.collect())
        docs = after
    return out


def test_quality_stage(spark, small_sf, stages):
    before, after = stages["quality classifier"]
    labels = spark.read.parquet(f"{small_sf}/labels.parquet").filter("crc32(cast(doc_id as string)) % 4 <> 2")
    model = quality.fit(spark.read.parquet(f"{small_sf}/documents.parquet"), labels)
    want = [r.doc_id for r, p in zip(before, quality.probabilities(model, [r.text or "" for r in before]), strict=True) if p >= 0.7]
    assert sorted(r.doc_id for r in after) == sorted(want) and 0 < len(want) < len(before)


def test_join_stage(stages):
    before, after = stages["n-gram Jaccard join"]
    whole = {r.doc_id: (r.text or "").lower().split() for r in before}
    sets = {i: {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set() for i, w in whole.items()}
    name = {i: i for i in sets}

    def root(i):
        while name[i] != i:
            i = name[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                low, high = sorted((root(a), root(b)))
                name[high] = low
    want = {root(i) for i in sets}
    assert {r.doc_id for r in after} == want and len(after) == len(want) < len(before)


def test_decontamination_stage(spark, small_sf, stages):
    before, after = stages["benchmark decontamination"]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{small_sf}/benchmark.parquet").collect()]
    found = {d for d, _ in test_decontaminate.by_hand([(r.doc_id, r.text) for r in before], items)}
    assert {r.doc_id for r in after} == {r.doc_id for r in before} - found and found


def test_personal_data_stage(stages):
    before, after = stages["PII"]
    texts = {r.doc_id: r.text for r in before}
    assert {r.doc_id for r in after} == set(texts)
    for r in after:
        spans = test_pii.by_hand(texts[r.doc_id])
        assert r.n_chars == len(r.text) and ("[" in r.text if spans else True)
        for span in filter(None, spans.split(",")):
            _, a, b = span.split(":")
            assert texts[r.doc_id][int(a) : int(b)] not in r.text


def test_packing_stage(stages, encoders):  # noqa: F811
    before, after = stages["packing"]
    number = {r.doc_id: k for k, r in enumerate(before)}
    rows = [type("Piece", (), {**r.asDict(), "doc_id": number[r.doc_id]}) for r in after]
    test_packing.check_pieces(rows, [r.text for r in before], encoders[1], 1024)


def test_run_ends_with_the_last_stage(spark, small_sf, stages):
    rows = corpus_pipeline.run(spark, small_sf).collect()
    assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in stages["packing"][1])


def test_quality_stage_without_labels_keeps_all(spark, docs_of, sf_of):
    docs = docs_of(["one line\nand another", "", None])
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    folder = sf_of(documents=docs, labels=labels)
    assert corpus_pipeline.good_quality(spark, docs, folder).count() == 3
