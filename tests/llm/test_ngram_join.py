import random

import numpy as np
import pytest

from notewright.llm import graph, ngram_join
from notewright.llm.queries import QUERIES
from notewright.llm.shingles import words


def sets_of(text):
    w = words(text)
    return {tuple(w[i : i + 4]) for i in range(len(w) - 3)} if len(w) >= 4 else ({tuple(w)} if w else set())


def by_hand(texts):
    sets = {i: sets_of(t) for i, t in texts.items()}
    name = {i: i for i in sets}

    def root(i):
        while name[i] != i:
            i = name[i]
        return i

    holders = {}
    for i, s in sets.items():
        for t in s:
            holders.setdefault(t, []).append(i)
    pairs = {(a, b) for ids in holders.values() for k, a in enumerate(ids) for b in ids[k + 1 :]}
    for a, b in pairs:
        shared = len(sets[a] & sets[b])
        if 100 * shared >= 85 * len(sets[a] | sets[b]):
            low, high = sorted((root(a), root(b)))
            name[high] = low
    return {i: (len(sets[i]), root(i)) for i in sets}


def check(rows, texts):
    assert len(rows) == len(texts)
    want = by_hand(texts)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == want
    return want


def varied(draw, base, edits):
    out = list(base)
    for _ in range(edits):
        out[draw.randrange(len(out))] = draw.choice("pqrstuvw") + str(draw.randrange(1000))
    return " ".join(out)


def test_query_on_table(spark, small_sf):
    folder = small_sf.replace("sf0.001", "sf0.01")
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    want = check(QUERIES["op9_ngram_join"](spark, folder).collect(), texts)
    assert sum(c != i for i, (_, c) in want.items()) > 10


@pytest.mark.parametrize("frequent", [0, 50, 10**5])
def test_near_copies_at_the_border(spark, docs_of, sf_of, monkeypatch, frequent):
    monkeypatch.setattr(ngram_join, "FREQUENT", frequent)
    draw = random.Random(frequent)
    passage = " ".join(f"common{k}" for k in range(60))
    bases = [[f"w{draw.randrange(400)}" for _ in range(draw.choice([5, 12, 60, 200]))] for _ in range(25)]
    texts = [varied(draw, b, draw.choice([0, 0, 1, 1, 2, 3, 5])) for b in bases for _ in range(8)]
    texts += [f"{varied(draw, bases[3], 50)} {passage}" for _ in range(20)] + [passage, passage + " x", "a b c", "A b  c", "b c a"]
    texts += [None, "", " \n", "same row", "same row", "long " * 20000]
    texts = dict(enumerate(texts))
    folder = sf_of(documents=docs_of(list(texts.values())))
    check(QUERIES["op9_ngram_join"](spark, folder).collect(), texts)


def test_null_ids_and_empty_table(spark, docs_of):
    rows = ngram_join.join_documents(docs_of(["a b c d", "a b c d", ""], [None, 5, None])).collect()
    assert sorted((r.n_shingles, r.component_id or -1) for r in rows) == [(0, -1), (1, 5), (1, 5)]
    assert ngram_join.join_documents(docs_of([])).count() == 0
    kept = ngram_join.one_of_each(docs_of(["a b c d", "a b c d", "", "", "e f g h i"])).collect()
    assert sorted(r.doc_id for r in kept) == [0, 2, 3, 4]


def test_one_of_each_with_ids_on_several_rows(spark, docs_of):
    rows = [(7, "a b c d"), (7, "a b c d"), (7, "A  b c d"), (7, "other words here now"), (9, "a b c d"), (7, ""), (None, "a b c d")]
    kept = ngram_join.one_of_each(docs_of([t for _, t in rows], [i for i, _ in rows]))
    assert kept.columns == docs_of([]).columns
    got = sorted((r.doc_id or 0, r.text) for r in kept.collect())
    assert got == [(0, "a b c d"), (7, ""), (7, "A  b c d"), (7, "other words here now")]


def test_components_of_chains_and_stars(spark):
    draw = random.Random(4)
    edges = [(k, k + 1) for k in range(60)] + [(100, k) for k in range(101, 130)] + [(200, 200)]
    names = list(range(300))
    draw.shuffle(names)
    rows = spark.createDataFrame([(names[a], names[b]) for a, b in edges], "a long, b long")
    got = {r.node: r.component for r in graph.components(rows).collect()}
    chain, star = [names[k] for k in range(61)], [names[k] for k in range(100, 130)]
    assert {got[k] for k in chain} == {min(chain)} and {got[k] for k in star} == {min(star)} and len(got) == 91


def test_prefixes_of_linked_sets_meet_under_every_order():
    rng = np.random.default_rng(0)
    none = ngram_join.Frequent(np.array([], np.uint64), np.array([], np.int64))
    for size in range(1, 80):
        a = np.unique(rng.integers(0, 2**63, size).astype(np.uint64))
        lost = len(a) - ngram_join.least_overlap(len(a))
        b = a[lost:]
        if 100 * len(b) >= 85 * len(a):
            assert ngram_join.linked(*(ngram_join.Candidate(s, none, 85) for s in (a, b)))


def test_columns_of_any_name_stay(spark, docs_of):
    texts = ["a b c d e f g h", "a b c d e f g h", "x y z", None]
    docs = docs_of(texts, [4, 4, 2, None]).selectExpr("*", "1 as __id", "2 as __key", "3 as __first", "4 as __nth", "5 as `__component`")
    kept = ngram_join.one_of_each(docs).collect()
    assert sorted((r.doc_id or 0, r["__id"], r["__key"], r["__first"], r["__nth"], r["__component"]) for r in kept) == [
        (0, 1, 2, 3, 4, 5), (2, 1, 2, 3, 4, 5), (4, 1, 2, 3, 4, 5)
    ]
