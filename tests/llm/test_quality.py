import itertools
import zlib

import numpy as np

from notewright.llm import quality
from notewright.llm.queries import QUERIES

LABELS = "doc_id long, quality int, toxic int"


def test_forward_backward_against_all_labelings():
    rng = np.random.default_rng(3)
    scores, counts, moves = rng.normal(size=7), np.array([3, 0, 1, 3]), rng.normal(size=(2, 2))
    ahead, behind = quality.forward_backward(scores, counts, moves)
    at = 0
    for n in counts:
        weight = np.zeros((n, 2))
        for states in itertools.product((0, 1), repeat=int(n)):
            w = np.exp(sum(scores[at + t] for t in range(n) if states[t]) + sum(moves[a, b] for a, b in zip(states, states[1:])))
            for t in range(n):
                weight[t, states[t]] += w
        np.testing.assert_allclose((ahead + behind)[at : at + n], np.log(weight[:, 1] / weight[:, 0]), rtol=1e-9)
        at += n


def test_features_see_neighbours_but_not_other_texts():
    one, _, c1 = quality.line_features(["a b.\nXX!!\n\n c"])
    both, lengths, c2 = quality.line_features(["a b.\nXX!!\n\n c", "", "zz"])
    assert c1.tolist() == [3] and c2.tolist() == [3, 0, 1] and lengths.tolist() == [4, 4, 2, 2]
    np.testing.assert_allclose(quality.with_neighbours(both, c2)[:3], quality.with_neighbours(one, c1))


def accuracy(spark, folder):
    rows = QUERIES["op2_quality"](spark, folder).collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7)
    seen = [r.predicted == labels[r.doc_id] for r in rows if r.held_out and r.doc_id in labels]
    return len(rows), sum(seen) / len(seen)


def test_held_out_accuracy(spark, small_sf):
    folder = small_sf.replace("sf0.001", "sf0.01")
    rows, share = accuracy(spark, folder)
    assert rows == spark.read.parquet(f"{folder}/documents.parquet").count() and share > 0.95


def test_odd_texts_ties_and_missing_labels(spark, docs_of, sf_of):
    texts = [None, "", " \n", "Fine words here.\nAnd more.", "#### $$$$ !!!!"] * 30 + ["long line " * 20000, "a\n" * 20000]
    labels = [(i, int(i % 5 != 4), 0) for i in range(150)] + [(3, 1, 0), (3, None, None), (None, 1, 0), (10**6, 0, 0)]
    folder = sf_of(documents=docs_of(texts), labels=spark.createDataFrame(labels, LABELS))
    rows = {r.doc_id: r for r in QUERIES["op2_quality"](spark, folder).collect()}
    assert len(rows) == len(texts)
    assert rows[0].score == rows[1].score == rows[2].score
    assert rows[3].predicted == 1 and rows[4].predicted == 0 and rows[8].score == rows[3].score
    none = sf_of(documents=docs_of(texts[:5]), labels=spark.createDataFrame([], LABELS))
    assert {r.score for r in QUERIES["op2_quality"](spark, none).collect()} == {0.5}
    empty = sf_of(documents=docs_of([]), labels=spark.createDataFrame(labels, LABELS))
    assert QUERIES["op2_quality"](spark, empty).count() == 0


def test_slices_do_not_change_scores(monkeypatch):
    texts = ["Fine words.\nMore of them.", "@@ ## !!", "", "x " * 50] * 5
    features, lengths, counts = quality.line_features(texts)
    model = quality.fit_crf(features, counts, np.tile([1.0, 0, 1, 1], 5), rounds=30)
    quality.calibrate(model, quality.aggregate(model, features, lengths, counts), np.tile([1.0, 0, 1, 1], 5))
    whole = quality.probabilities(model, texts)
    monkeypatch.setattr(quality, "_SLICE", 10)
    np.testing.assert_allclose(whole, quality.probabilities(model, texts))
