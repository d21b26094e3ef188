"""The trie walk against the tokenizers library."""

import hashlib

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tickloom.llm.bpe import Codec, digests, encoded

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "", " \n ", "don't WE'LL 'sun", "İstanbul ΣΑΣ ς", "a<|endoftext|>b <|startoftext|><|endoftext|> x", "日本語 テスト \x1c \x85 1234½²",
    "é é İ ﬁ 👍🏽 a\x00b", "ǅ ẞ straße", "a" * 3000 + " " + "ab" * 500, "ك عربي हिन्दी", "<|endoftext|", "the the THE", ":\U000323b0\ua7ceA 1\u1c89",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def codec():
    with open(PATH, encoding="utf-8") as file:
        return Codec(file.read())


def test_odd_texts(codec, library):
    for text in ODD:
        ids = library.encode(text, add_special_tokens=False).ids
        assert codec.encode(text) == ids
        assert codec.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_any_text(codec, library):
    @settings(max_examples=400, deadline=None)
    @given(st.text(alphabet=st.one_of(st.sampled_from("abcdetnhis' .,!?0<|>"), st.characters(codec="utf-8"))))
    def same(text):
        assert codec.encode(text) == library.encode(text, add_special_tokens=False).ids

    same()


def test_documents(spark, sf_dir, library):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = {r.doc_id: r for r in digests(docs, PATH).collect()}
    for doc_id, text in docs.select("doc_id", "text").collect():
        ids = library.encode(text, add_special_tokens=False).ids
        assert got[doc_id].n_tokens == len(ids)
        assert got[doc_id].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got[doc_id].decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_nulls_repeats_and_clashing_columns(spark):
    rows = [(1, None, "i", "d"), (1, None, "i", "d"), (None, "the cat", "i", "d"), (2, "", "i", "d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, decoded string")
    got = sorted(((r.doc_id, r.ids, r.decoded) for r in encoded(docs, PATH).collect()), key=str)
    assert got[:3] == [(1, [], ""), (1, [], ""), (2, [], "")]
    assert got[3][2] == "the</w> cat</w>"
    assert encoded(docs.limit(0), PATH).collect() == []
