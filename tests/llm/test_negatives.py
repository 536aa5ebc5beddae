import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from notewright.llm import negatives
from notewright.llm.queries import QUERIES

KIND = "vec_id long, embedding array<float>, label int"


def usable(rows):
    def fine(v):
        return v is not None and all(x is not None and math.isfinite(x) for x in v)

    return [(i, np.array([math.floor(256 * float(np.float32(x))) for x in v], object), c) for i, v, c in rows if None not in (i, c) and fine(v)]


def product(a, b):
    return int(sum(x * y for x, y in zip(a, b, strict=False)))


def brute(rows, anchor=lambda i: i % 50 == 0, positives=5, keep=3):
    rows, out = usable(rows), []
    first = {}
    for i, v, c in sorted((r for r in rows if anchor(r[0])), key=lambda r: (r[0], r[2], list(r[1]))):
        first.setdefault(i, (v, c))
    for a, (v, c) in first.items():
        same = sorted((-product(v, w), i) for i, w, d in rows if d == c and i != a)[:positives]
        other = sorted((-product(v, w), i) for i, w, d in rows if d != c)
        for score, p in same:
            held = [(-s, n) for s, n in other if -50 * score <= -100 * s <= -95 * score][:keep]
            out += [(a, p, r + 1, n, -score, s) for r, (s, n) in enumerate(held)]
    return sorted(out)


def mined(frame, **kw):
    return sorted(map(tuple, negatives.mine(frame, F.col("vec_id") % 50 == 0, **kw).collect()))


def made(n, dims, seed, labels=4, spread=1.0):
    rng = np.random.default_rng(seed)
    return [(i, [float(x) for x in rng.normal(0.2, spread, dims)], int(rng.integers(labels))) for i in range(n)]


@pytest.mark.parametrize("tree_rows, leaf, block, slot", [(8192, 128, 1024, 16), (64, 8, 3, 1), (50, 4, 1, 2)])
def test_equals_brute_force_at_any_packing(spark, monkeypatch, tree_rows, leaf, block, slot):
    for name, value in (("TREE_ROWS", tree_rows), ("LEAF_ROWS", leaf), ("BLOCK_ROWS", block), ("TREES_OF_A_SLOT", slot), ("ANCHORS_OF_A_GROUP", slot)):
        monkeypatch.setattr(negatives, name, value)
    rows = made(400, 6, 1)
    assert mined(spark.createDataFrame(rows, KIND)) == brute(rows)


def test_ties_and_one_common_vector(spark, monkeypatch):
    monkeypatch.setattr(negatives, "TREE_ROWS", 32)
    monkeypatch.setattr(negatives, "LEAF_ROWS", 8)
    rows = [(i, [1.0, 0.5] if i % 3 else [0.8, 0.25 * (i % 4)], i % 2) for i in range(300)]
    want = brute(rows)
    assert want and mined(spark.createDataFrame(rows, KIND)) == want


def test_nulls_odd_vectors_and_repeated_ids(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 1.0], 0), (1, [1.0, None], 0), (2, [nan, 1.0], 0), (3, [inf, 1.0], 1), (4, None, 0), (None, [1.0, 1.0], 0)]
    rows += [(5, [1.0, 1.0], None), (6, [1.0], 0), (7, [], 0), (8, [0.9, 0.2, 5.0], 1), (9, [0.5, 0.5], 1), (10, [1.0, 1.0], 0)]
    rows += [(0, [1.0, 1.0], 0), (50, [0.2, 0.4], 1), (50, [0.3, 0.4], 0), (11, [-1.0, -1.0], 0), (12, [0.6, 0.5], 1), (12, [0.6, 0.5], 1)]
    frame = spark.createDataFrame(rows, KIND).selectExpr("*", "1 as id", "2 as vector", "3 as slot", "4 as anchor")
    want = brute(rows)
    assert want and mined(frame) == want


def test_large_components_stay_exact(spark):
    rows = [(i, [float(2**18 + 37 * i % 101), float(i % 7), -3.25 * i], i % 3) for i in range(120)]
    big = [(i, [x * 2.0**3 for x in v], c) for i, v, c in rows]
    assert mined(spark.createDataFrame(big, KIND)) == brute(big)
    with pytest.raises(ValueError):
        mined(spark.createDataFrame([(0, [2.0**40], 0)], KIND))


def test_empty_tables_and_no_anchor(spark):
    assert mined(spark.createDataFrame([], KIND)) == []
    assert mined(spark.createDataFrame([(1, [1.0], 0), (2, [1.0], 1)], KIND)) == []
    assert mined(spark.createDataFrame([(0, [1.0], 0), (2, [1.0], 1)], KIND)) == []


def test_boxes_leave_leaves_unopened():
    rng = np.random.default_rng(2)
    shape = negatives.Shape(0, 2, "i2", "f8")
    vectors = rng.integers(-500, 500, (4096, 2)).astype("f8")
    leaves = [np.sort(x) for x in negatives._tiles(vectors, 5)]
    assert sorted(np.concatenate(leaves)) == list(range(4096)) and max(map(len, leaves)) <= negatives.LEAF_ROWS
    order, ends = np.concatenate(leaves), np.concatenate(([0], np.cumsum([len(x) for x in leaves])))
    tree = (order, vectors[order], *(np.stack([f(vectors[x], axis=0) for x in leaves]) for f in (np.min, np.max)), ends)
    queries = vectors[:64]
    best = negatives.Best(64, 1, 5, shape)
    anchors = (np.arange(64), queries, *(np.full((64, 1), x) for x in negatives._ANY))
    opened = negatives.search_tree(best, anchors, tree, True, shape)
    assert opened < 64 * len(leaves) / 3
    scores = queries @ vectors.T
    scores[np.arange(64), np.arange(64)] = -np.inf
    want = [sorted(range(4096), key=lambda j, i=i: (-scores[i, j], j))[:5] for i in range(64)]
    assert best.ids[:, 0].tolist() == want


def test_query_moves_labels(spark, sf_of):
    rows = made(300, 5, 3, labels=10, spread=0.3)
    rows[14] = (14, rows[14][1], None)
    folder = sf_of(embeddings=spark.createDataFrame(rows, KIND))
    moved = [(i, v, (c + 1) % 10 if i % 7 == 0 and c is not None else c) for i, v, c in rows]
    got = sorted(map(tuple, QUERIES["op11_hard_negatives"](spark, folder).collect()))
    assert got == brute(moved) and got
