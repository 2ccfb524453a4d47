"""Ids and decoded texts equal the library's."""

import hashlib
from types import SimpleNamespace

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer as Library

from lapsewise.llm.bpe import Codec, Tokenizer
from lapsewise.llm.queries import QUERIES, TOKENIZER

ODD = [
    "", "  \n\t ", "a\x1cb", "foo<|endoftext|>bar <|startoftext|>", "ΣΑΣ ΟΔΟΣ İstanbul ǅ ﬁ é ẞ 中文字 ９９ ²x½",
    "'S it's I'LL ''s !'s", "aaaaaaaaaaaaaaaaaaaaaaaaa " * 3, "\xa0x\u2003y\u0085z\u200bq", "日本語🎉🎉 emoji👩‍👩‍👧",
    "Ÿſ Ɓ \u0300a", "ab\x00cd", "x" * 5000, "éèêñß¡¿ " * 50, "_a_b __ 1234567",
]


@pytest.fixture(scope="module")
def codec():
    with open(TOKENIZER, encoding="utf-8") as file:
        return Codec(file.read())


@pytest.fixture(scope="module")
def library():
    return Library.from_file(TOKENIZER)


def check(codec, library, texts):
    for text, ids in zip(texts, codec.encode(texts), strict=True):
        wanted = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == wanted, text[:80]
        assert codec.decode(ids) == library.decode(wanted, skip_special_tokens=False)


def test_odd_texts(codec, library):
    check(codec, library, ODD)


def test_every_fragment_is_merged_here(codec, library):
    """Special tokens and spaces beyond ASCII: the library may normalise and split, but never encode."""
    texts = [
        "prix\xa0: 12\xa0€ «\xa0été\xa0»", "東京\u3000大阪\u3000日本語", "a\x1c\x1db\x85c\u2028d\u2029e\u202ff\u205fg\u1680h",
        "<|endoftext|>", "<|endoftext|><|endoftext|>x", "a <|startoftext|>\xa0b<|endoftext|> c\n", "<|endoftext", "É\u0301<|endoftext|>\u0301e",
        "\u2000\u0301a \u0301b", " ".join(f"mot{i}\xa0<|endoftext|>" for i in range(3000)),
    ]
    wanted = [library.encode(t, add_special_tokens=False).ids for t in texts]
    whole = codec.library
    codec.library = SimpleNamespace(normalizer=whole.normalizer, pre_tokenizer=whole.pre_tokenizer)
    try:
        assert [np.frombuffer(x, "<u4").tolist() for x in codec.encode(texts)] == wanted
    finally:
        codec.library = whole


SPACED = st.text(st.sampled_from("aZé1'\xa0\x85\x1c\u2000\u2001\u3000\u0301\u2028 \n日"), max_size=30)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(SPACED, st.sampled_from(["<|endoftext|>", "<|startoftext|>", "<|end"])), max_size=6))
def test_any_mix_of_spaces_and_special_tokens(codec, library, parts):
    check(codec, library, ["".join(parts)])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=60), max_size=5))
def test_any_text(codec, library, texts):
    check(codec, library, [t for t in texts if not any("\ud800" <= c <= "\udfff" for c in t)])


def test_cuts_are_where_no_token_holds_the_pair(codec):
    pair = np.argwhere(~codec.inside[:, :256])[0]
    marks = [c for c in sorted(codec.byte_of, key=codec.byte_of.get)]
    held = "".join(marks[b] for b in pair)
    assert not any(held in t.removesuffix("</w>")[:-1] or held in t and not t.endswith("</w>") for t in codec.tokens.values())


def test_query(spark, sf_dir, documents, library):
    got = {r.doc_id: r for r in QUERIES["op10_bpe_forced_boundaries"](spark, sf_dir).collect()}
    assert len(got) == len(documents)
    for doc_id, text in documents:
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert got[doc_id].n_tokens == len(ids)
        assert got[doc_id].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        decoded = library.decode(ids, skip_special_tokens=False)
        assert got[doc_id].decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def test_columns(spark, odd_documents, no_documents, library):
    own = Tokenizer(spark, TOKENIZER)
    rows = odd_documents.withColumn("ids", own.encode("text")).withColumn("back", own.decode("ids")).collect()
    for r in rows:
        wanted = library.encode(r.text or "", add_special_tokens=False).ids
        assert np.frombuffer(r.ids, "<u4").tolist() == wanted
        assert r.back == library.decode(wanted, skip_special_tokens=False)
    assert no_documents.select(own.round_trip("text")).collect() == []
