import hashlib
import re

import numpy as np
import pytest

from notewright.llm import minhash
from notewright.llm.queries import QUERIES
from notewright.llm.shingles import WordHashes, shingle_set, words

ODD = [None, "", " \t", "one", "One two", "é🙂 b c d e f g h", "w" * 20000, " ".join(map(str, range(20000))), "one", "one"]


def test_words():
    text = "ÀB \x0bCd\x1fE f\tG\r\nh\x0c"
    want = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    assert [w.decode() for w in words(text)] == want


def jaccard(a, b):
    found = [words(a), words(b)]
    sets = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set() for w in found]
    return len(sets[0] & sets[1]) / len(sets[0] | sets[1]) if sets[0] | sets[1] else 1.0


def check(rows, texts):
    order = sorted(texts, key=lambda i: (i is not None, i))
    assert len(rows) == len(order)
    of, got = minhash.Fingerprints(), {r.doc_id: r for r in rows}
    for i, following in zip(order, [*order[1:], order[0]], strict=True):
        text, other, r = texts[i] or "", texts[following] or "", got[i]
        changed = minhash.edited(text, other)
        assert r.n_chars == len(text)
        assert r.edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        assert r.fingerprint == of(text).tobytes().hex()
        assert r.edited_fingerprint == of(changed).tobytes().hex()
        assert abs(r.near_edited - jaccard(text, changed)) < 0.2
        assert abs(r.near_next - jaccard(text, other)) < 0.2


@pytest.mark.parametrize("parts", [1, 3, 7])
def test_query_on_odd_texts(spark, docs_of, sf_of, parts):
    ids = [None, *range(-3, len(ODD) - 4)]
    folder = sf_of(documents=docs_of(ODD, ids))
    found = minhash.compare_edits(spark.read.parquet(f"{folder}/documents.parquet"), parts)
    from pyspark.sql import functions as F

    check(found.withColumn("edited_sha256", F.sha2("edited", 256)).collect(), dict(zip(ids, ODD, strict=True)))


def test_query_on_table(spark, small_sf):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{small_sf}/documents.parquet").collect()}
    check(QUERIES["op7_minhash"](spark, small_sf).collect(), texts)


def test_single_row_empty_table_and_ties(spark, docs_of):
    (only,) = minhash.compare_edits(docs_of(["a b c d"]), 4).collect()
    assert only.edited == "a b ca"[:7] or only.near_next == 1.0
    assert minhash.compare_edits(docs_of([]), 4).count() == 0
    assert minhash.compare_edits(docs_of(["x", "y", "x"], [7, 7, 7]), 4).count() == 3


def test_signature_in_chunks_is_the_same(monkeypatch):
    found = shingle_set(" ".join(map(str, range(3000))), 5, WordHashes())
    whole = minhash.signature(found, minhash.permutations())
    monkeypatch.setattr(minhash, "_CHUNK", 64)
    assert np.array_equal(whole, minhash.signature(found, minhash.permutations()))


def test_near_duplicates(spark, small_sf):
    docs = spark.read.parquet(f"{small_sf}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    name = {i: i for i in texts}

    def root(i):
        while name[i] != i:
            i = name[i]
        return i

    sets = {i: set(shingle_set(t, 5, WordHashes()).tolist()) for i, t in texts.items()}
    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                low, high = sorted((root(a), root(b)))
                name[high] = low
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(docs).collect()}
    assert got == {i: root(i) for i in texts} and any(i != c for i, c in got.items())
