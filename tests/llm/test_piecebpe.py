import hashlib

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from notewright.llm import piecebpe
from notewright.llm.queries import QUERIES

PATH = public_tokenizers.path("piece_bpe_32k.model")
ODD = [None, "", " ", "   a  b ", "\n\t x", "▁a▁▁b", "<s> </s> <0x41>", "x\x00y", "🙂梦é́", "a" * 3000, "   "]
ODD += ["the cat " * 3000, "=" * 200, " " * 100 + "hello", "one", "one"]


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def encoder():
    return piecebpe.Encoder(piecebpe.read_model(PATH))


_PARTS = st.sampled_from([" ", "  ", "▁", "the", "in", "ation", "aaaa", "\n", "\t", "é", "梦", "🙂", "=", "://", "0", "ing", "x", "\x00"])


@settings(max_examples=1500, deadline=None)
@given(text=st.one_of(st.text(max_size=60), st.lists(_PARTS, max_size=25).map("".join)))
def test_ids_and_text_are_those_of_the_library(encoder, library, text):
    ids, decoded = encoder.encode(text)
    want = library.encode(text)
    assert list(ids) == want
    assert decoded == library.decode(want) == encoder.decode(want)


@settings(max_examples=500, deadline=None)
@given(ids=st.lists(st.one_of(st.integers(0, 262), st.integers(0, 31999)), max_size=12))
def test_any_ids_decode_as_in_the_library(encoder, library, ids):
    assert encoder.decode(ids) == library.decode(ids)


def test_every_piece_that_merging_reaches_is_one_token(encoder, library):
    for text in list(encoder._rank)[::37]:
        bare = text.removeprefix(piecebpe.SPACE)
        assert list(encoder.encode(bare)[0]) == library.encode(bare)


def test_memory_of_chunks_and_pairs_is_bounded(library, monkeypatch):
    monkeypatch.setattr(piecebpe, "_MOST_REMEMBERED", 5)
    small = piecebpe.Encoder(piecebpe.read_model(PATH))
    text = " ".join(f"word{i} thing{i % 7}" for i in range(300))
    assert list(small.encode(text)[0]) == library.encode(text)
    assert len(small._chunks) <= 5 and len(small._older) <= 5 and len(small._pairs) <= 50


def test_without_cuts_ids_are_the_same(encoder, library):
    whole = piecebpe.Encoder(piecebpe.read_model(PATH))
    whole._cut = None
    text = "Some  text, with\nlines and 123 numbers. " * 20
    assert list(whole.encode(text)[0]) == library.encode(text)


def test_query_on_odd_texts(spark, docs_of, sf_of, library):
    ids = [None, 7, 7, *range(len(ODD) - 3)]
    docs = docs_of(ODD, ids).selectExpr("*", "1 as ids", "2 as decoded")
    folder = sf_of(documents=docs)
    got = QUERIES["op13_sentencepiece"](spark, folder).collect()

    def row(key, text):
        found = library.encode(text or "") + [library.eos_id()]
        digest = hashlib.sha256(" ".join(map(str, found)).encode()).hexdigest()
        return key, len(found), digest, hashlib.sha256(library.decode(found).encode()).hexdigest()

    want = [row(key, text) for key, text in zip(ids, ODD, strict=True)]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_slices_of_a_batch_keep_all_rows(spark, docs_of, library, monkeypatch):
    monkeypatch.setattr(piecebpe, "_CHARACTERS_AT_ONCE", 10)
    texts = ["some text", "more", None, "text again " * 3]
    got = piecebpe.encode(docs_of(texts), PATH, end=False).orderBy("doc_id").collect()
    assert [list(r.ids) for r in got] == [library.encode(t or "") for t in texts]


def test_empty_table_and_other_models(spark, docs_of, tmp_path):
    assert piecebpe.encode(docs_of([]), PATH).collect() == []
    from sentencepiece import sentencepiece_model_pb2 as proto

    model = proto.ModelProto()
    with open(PATH, "rb") as file:
        model.ParseFromString(file.read())
    model.normalizer_spec.remove_extra_whitespaces = True
    (tmp_path / "m").write_bytes(model.SerializeToString())
    with pytest.raises(ValueError):
        piecebpe.read_model(str(tmp_path / "m"))
