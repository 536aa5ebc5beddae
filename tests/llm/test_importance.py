import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest

from notewright.llm import importance
from notewright.llm.queries import QUERIES

ODD = [None, "", "-- ..", "One two", "ÀB é🙂 c_d e9", "w" * 5000, "x y z " * 400, "one", "one", "a\x00b\tc d"]


def grams(text, least, most):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)
    found = [" ".join(words[i : i + n]) for n in range(least, most + 1) for i in range(len(words) - n + 1)]
    return len(words), [zlib.crc32(x.encode()) for x in found]


def brute(texts, ids, target, share, least, most, buckets, min_words, seed):
    s, t = Counter(), Counter()
    for text in texts:
        s.update(c % buckets for c in grams(text, least, most)[1])
    for text in target:
        t.update(c % buckets for c in grams(text, least, most)[1])
    all_s, all_t = sum(s.values()) + buckets, sum(t.values()) + buckets
    rows = []
    for key, text in zip(ids, texts, strict=True):
        words, crcs = grams(text, least, most)
        of = [c % buckets for c in crcs]
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * all_s / ((s[b] + 1) * all_t))) for b in of)
        h = int(hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        rows.append((key, len(of), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), words))
    long = sorted((r for r in rows if r[4] >= min_words), key=lambda r: (-r[3], r[0] is not None, r[0] or 0, r[1]))
    rank = [(*r[:4], i + 1 if i < share * len(long) // 100 else None) for i, r in enumerate(long)]
    return sorted([*rank, *((*r[:4], None) for r in rows if r[4] < min_words)], key=str)


@pytest.mark.parametrize("block", [1 << 20, 30])
@pytest.mark.parametrize("sizes", [(1, 1), (1, 3), (2, 4)])
def test_crcs_from_prefixes(sizes, block, monkeypatch):
    monkeypatch.setattr(importance, "_BLOCK", block)
    rng, shifts = random.Random(5), importance.Shifts()
    texts = [*ODD, *("".join(rng.choice("aZb 9é\t_-🙂") for _ in range(rng.randint(0, 200))) for _ in range(100))]
    for text in texts:
        found = list(importance.ngram_crcs(text or "", *sizes, shifts))
        words, want = grams(text, *sizes)
        assert sum(n for n, _ in found) == words
        assert sorted(int(c) for _, crcs in found for c in crcs) == sorted(want)


@pytest.mark.parametrize("share", [10, 50, 100])
def test_resampling_equals_brute_force(spark, docs_of, share):
    texts = [*ODD, *(" ".join(random.Random(i).choices("red green blue sky sea".split(), k=i)) for i in range(40))]
    ids = [None, 5, 5, *range(6, len(texts) + 3)]
    target = ["the blue sea", None, "blue"]
    docs = docs_of(texts, ids).selectExpr("*", "1 as score", "2 as rank", "3 as short")
    got = importance.resample(docs, docs_of(target), share, 1, 2, 97, 3, 11)
    assert sorted(map(tuple, got.collect()), key=str) == brute(texts, ids, target, share, 1, 2, 97, 3, 11)


def test_empty_tables(spark, docs_of):
    assert importance.resample(docs_of([]), docs_of(["a"]), 10).collect() == []
    got = importance.resample(docs_of(["a b c"]), docs_of([]), 100, min_words=1).collect()
    assert [(r.n_features, r["rank"]) for r in got] == [(5, 1)]


def test_query_equals_brute_force(spark, docs_of, sf_of):
    texts = [" ".join(random.Random(i).choices("red green blue sky sea".split(), k=i)) for i in range(60)]
    benchmark = spark.createDataFrame([(1, "blue sky"), (2, None)], "item_id long, text string")
    folder = sf_of(documents=docs_of(texts), benchmark=benchmark)
    got = QUERIES["op12_importance"](spark, folder).collect()
    want = brute(texts, list(range(60)), ["blue sky", None], 10, 1, 1, 10000, 20, 2024)
    assert sorted(map(tuple, got), key=str) == want


def test_a_bad_range_is_refused(docs_of):
    with pytest.raises(ValueError):
        importance.resample(docs_of(["a"]), docs_of(["a"]), 10, least=2, most=1)
