import zlib

import numpy as np
import pytest
from hypothesis import given
from hypothesis import settings as hsettings
from hypothesis import strategies as st

pytest.importorskip("public_tokenizers")
import public_tokenizers  # noqa: E402
from tokenizers import Tokenizer  # noqa: E402

from notewright.llm import packing  # noqa: E402
from notewright.llm.bytebpe import ByteBpe, read_vocabulary  # noqa: E402
from notewright.llm.queries import QUERIES, packed  # noqa: E402

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = [None, "", " ", "a", "<|endoftext|>x", "  two  \n\nlines\t", "é🙂" * 40, "word " * 3000, "z" * 5000, "a", "a"]


@pytest.fixture(scope="module")
def encoders():
    with open(PATH, encoding="utf-8") as f:
        return ByteBpe(read_vocabulary(PATH)), Tokenizer.from_file(PATH)


@hsettings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_same_ids_as_library(encoders, text):
    own, library = encoders
    assert own.ids(text).tolist() == library.encode(text, add_special_tokens=False).ids


def test_balance_takes_cheapest_with_room():
    placed = packing.balance(np.array([600, 500, 400, 100]), 1000, 1.0, 0.001)
    where = {p: s for p, _, _, s, _ in placed}
    assert where[0] != where[1] and where[2] == where[0] or where[2] == where[1]
    assert where[2] == where[1]  # the cheaper of both


def check_pieces(rows, texts, library, capacity):
    ids = {i: library.encode(t or "", add_special_tokens=False).ids + [0] for i, t in enumerate(texts)}
    pieces, sequences = {}, {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert set(pieces) == set(ids)
    for i, found in pieces.items():
        at = 0
        for r in sorted(found, key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids[i])
            assert r.ids_crc32 == zlib.crc32(np.array(ids[i][at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids[i])
    for spans in sequences.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= capacity
    return sequences


def test_query_on_odd_texts(spark, docs_of, sf_of, encoders):
    docs = docs_of(ODD).withColumnRenamed("n_chars", "length").repartition(3)
    rows = QUERIES["op10_packing"](spark, sf_of(documents=docs)).collect()
    check_pieces(rows, ODD, encoders[1], 1024)


def test_query_on_table(spark, small_sf, encoders):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{small_sf}/documents.parquet").collect()}
    rows = QUERIES["op10_packing"](spark, small_sf).collect()
    sequences = check_pieces(rows, [texts[i] for i in range(len(texts))], encoders[1], 1024)
    assert sum(1024 - sum(n for _, n in s) for s in sequences.values()) < 1024


def test_empty_table(spark, docs_of):
    assert packing.pack(docs_of([]), PATH).count() == 0


def test_shards_span_small_batches(spark, docs_of, encoders):
    """Batches of few rows or bytes bound the memory; they must not cost padding."""
    texts = [f"text {i} " * (1 + i % 40) for i in range(300)]
    docs = docs_of(texts).coalesce(1)
    rows_of_batch = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(rows_of_batch)
    spark.conf.set(rows_of_batch, "10")
    try:
        sequences = check_pieces(packed(docs).collect(), texts, encoders[1], 1024)
    finally:
        spark.conf.set(rows_of_batch, before)
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == "4m"
    assert sum(1024 - sum(n for _, n in s) for s in sequences.values()) < 1024


def test_shards_end_at_their_tokens(spark, docs_of, encoders, monkeypatch):
    monkeypatch.setattr(packing, "SHARD_TOKENS", 2000)
    texts = ["word " * 300] * 40
    sequences = check_pieces(packed(docs_of(texts).coalesce(1)).collect(), texts, encoders[1], 1024)
    assert len(sequences) > -(-40 * 302 // 1024)  # each shard ends with a sequence of its own
