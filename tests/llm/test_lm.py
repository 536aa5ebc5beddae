import math
import re
import zlib
from collections import Counter

import numpy as np

from notewright.llm import lm
from notewright.llm.queries import QUERIES
from notewright.llm.shingles import words


def tokens(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", lowered), None]


def check_base(rows, texts):
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in texts}
    counts = Counter(t for i, text in texts.items() if not held[i] for t in tokens(text))
    total, types = sum(counts.values()), len(counts)
    assert {r.doc_id for r in rows} == set(texts) and len(rows) == len(texts)
    for r in rows:
        found = tokens(texts[r.doc_id])
        assert (r.held_out, r.n_tokens, r.train_tokens) == (held[r.doc_id], len(found), total)
        assert r.n_known == sum(t in counts for t in found)
        want = sum(math.log10((counts[t] + 1) / (total + types + 1)) for t in found)
        assert abs(r.base_score - want) < 1e-6 * abs(want) + 1e-9
        assert -1e9 < r.score < 0


def test_query_on_table(spark, small_sf, monkeypatch):
    monkeypatch.setattr(lm, "HOT_WORDS", 300)  # so that both ways of scoring take part
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{small_sf}/documents.parquet").collect()}
    rows = QUERIES["op1_hpylm"](spark, small_sf).collect()
    check_base(rows, texts)
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_hot_table_and_join_agree(spark, small_sf, monkeypatch):
    docs = spark.read.parquet(f"{small_sf}/documents.parquet").limit(40)
    model = lm.fit(docs.select("text"))
    both = []
    for hot in (0, 3000):
        monkeypatch.setattr(lm, "HOT_WORDS", hot)
        both.append({r.doc_id: (r.score, r.base_score, r.n_known) for r in lm.score(docs, model).collect()})
    assert both[0].keys() == both[1].keys()
    for i in both[0]:
        np.testing.assert_allclose(both[0][i], both[1][i], rtol=1e-5)


def test_probabilities_add_up(spark, small_sf):
    docs = spark.read.parquet(f"{small_sf}/documents.parquet")
    model = lm.fit(docs.select("text"))
    rows, totals = model.words.collect(), model.totals
    b1, b2 = totals.backoff(1), totals.backoff(2)
    alone = sum(10**r.lp0 for r in rows) + totals.unknown()
    assert abs(alone - 1) < 0.01
    for x in np.argsort(-totals.customers[2])[:5]:
        total = b2[x] * b1[x // lm.PER_CLASS] * totals.unknown()
        for r in rows:
            if x in r.x2:
                total += 10 ** r.lp2[r.x2.index(x)]
            elif x // lm.PER_CLASS in r.x1:
                total += b2[x] * 10 ** r.lp1[r.x1.index(x // lm.PER_CLASS)]
            else:
                total += b2[x] * b1[x // lm.PER_CLASS] * 10**r.lp0
        assert abs(total - 1) < 0.02


def test_tables_follow_their_conditional():
    rng, d, ratio = np.random.default_rng(0), 0.4, 0.7
    logs = lm.stirling_logs(d)
    drawn = lm.draw_tables(np.full(40000, 5), np.full(40000, ratio), d, logs, rng)
    weight = np.exp(logs[5, 1:6]) * ratio ** np.arange(1, 6)
    np.testing.assert_allclose(np.bincount(drawn, minlength=6)[1:] / 40000, weight / weight.sum(), atol=0.01)
    many = lm.draw_tables(np.array([1, 1000, 10**6]), np.array([1.0, 5.0, 50.0]), d, logs, rng)
    assert many[0] == 1 and 5 < many[1] < 300 and many[1] < many[2]


def test_odd_texts(spark, docs_of, sf_of):
    texts = [None, "", " \t\n", "A a a\x0bB", "é 🙂 ÀÉ", "w " * 20000, "x" * 20000, "dup dup", "dup dup", "rare-one"]
    texts = dict(zip([-5, *range(9)], texts, strict=True))
    folder = sf_of(documents=docs_of(list(texts.values()), list(texts)))
    check_base(QUERIES["op1_hpylm"](spark, folder).collect(), texts)
    twice = sf_of(documents=docs_of(["same text", "same text", None], [1, 1, None]))
    rows = QUERIES["op1_hpylm"](spark, twice).collect()
    assert len(rows) == 3 and len({(r.doc_id, r.score) for r in rows}) == 2
    assert QUERIES["op1_hpylm"](spark, sf_of(documents=docs_of([]))).count() == 0


def test_no_training_texts(spark, docs_of):
    model = lm.fit(docs_of([]).select("text"))
    (row,) = lm.score(docs_of(["one two"]), model).collect()
    assert row.n_known == 0 and math.isclose(row.score, 3 * math.log10(0.5))


def test_contexts():
    assert words("Ab\x0bC") == [b"ab", b"c"]
    assert all(0 <= lm.context_of(w) < lm.CONTEXTS for w in (b"a", b"z.", "é".encode(), b"9", b"!", lm._BEGIN, lm._END))


def test_every_preceding_word_has_a_restaurant(spark, docs_of):
    """Words of one class, told apart only by what follows them: the classes alone give each follower an eighth."""
    heads = [f"{c}xing" for c in "abcdefgh"]
    assert len({lm.context_of(h.encode()) for h in heads}) == 1
    texts = [f"{h} then{h[0]}" for h in heads for _ in range(12)]
    model = lm.fit(docs_of(texts).select("text"))
    assert model.before.count() == len(heads) * 2 + 1  # and the begin of a text
    right, wrong, strange = (
        r.score for r in sorted(lm.score(docs_of(["axing thena", "axing thenb", "zxing thena"]), model).collect(), key=lambda r: r.doc_id)
    )
    assert right - wrong > 1.0
    assert math.isfinite(strange) and strange < right


def test_probabilities_after_a_word_add_up(spark, docs_of):
    texts = ["a b", "a b", "a c", "a b d", "x b", "x c a"] * 5
    model = lm.fit(docs_of(texts).select("text"))
    vocabulary = ["a", "b", "c", "d", "x"]
    rows = lm.score(docs_of(["a", *[f"a {w}" for w in vocabulary]]), model).collect()
    before = {r.v: (r.customers, r.tables) for r in model.before.collect()}
    assert len(rows) == 6 and all(1 <= t <= c for c, t in before.values())
    words = {r.w: r for r in model.words.collect()}
    v = lm._signed(np.array([lm.xxhash.xxh3_64_intdigest(b"a")], np.uint64))[0]
    x, (customers, tables) = lm.context_of(b"a"), before[v]
    back = (lm.STRENGTH + model.discount * tables) / (lm.STRENGTH + customers)
    b1, b2 = model.totals.backoff(1)[x // lm.PER_CLASS], model.totals.backoff(2)[x]
    seen = {r.w: 10**r.lp for r in model.pairs.collect() if r.v == v}
    total = sum(seen.values()) + back * b2 * b1 * model.totals.unknown()
    for w, r in words.items():
        if w not in seen:
            in_class = 10 ** r.lp1[r.x1.index(x // lm.PER_CLASS)] if x // lm.PER_CLASS in r.x1 else b1 * 10**r.lp0
            total += back * (10 ** r.lp2[r.x2.index(x)] if x in r.x2 else b2 * in_class)
    assert abs(total - 1) < 0.02


def test_fit_leaves_no_shuffles_and_no_spent_tables(spark, small_sf):
    from pathlib import Path

    from notewright.session import shared_dir

    shared = Path(shared_dir(spark).removeprefix("file:"), "notewright")
    there = set(shared.glob("lm-*"))
    docs = spark.read.parquet(f"{small_sf}/documents.parquet")
    model = lm.fit(docs.select("text"))
    left = sorted(p.name.rsplit("-", 1)[0] for p in set(shared.glob("lm-*")) - there)
    assert left == ["lm-before", "lm-seen", "lm-words"]
    assert model.pairs.count() and model.words.count() and model.before.count()
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None) is None


def test_texts_are_read_once_to_score(spark, docs_of):
    model = lm.fit(docs_of(["a b c", "a b d"]).select("text"))
    docs, read = docs_of(["a b c", "a x d", None]), spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    assert len(lm.score(docs.mapInArrow(count, docs.schema), model).collect()) == 3
    assert read.value == 3
