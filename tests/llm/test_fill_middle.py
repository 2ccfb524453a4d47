"""Cuts, forms and round trips against a plain version, chunks and summaries on their own."""

import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lapsewise.llm import fill_middle as M
from lapsewise.llm.queries import QUERIES

WORDS = ["<P>", "<", "P", ">", "<S", "S>", "<M>", "a", "é", "日", "🎉", "\n", "\x00", " "]


def plain(doc_id, text):
    text = text or ""
    n = len(text)
    h = hashlib.sha256(f"1:{'null' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i : 8 * i + 8], 16) for i in range(4))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    if h4 % 100 < 20:
        return n, "spm", a, b - a, "<S>" + text[b:] + "<P>" + text[:a] + "<M>" + text[a:b]
    return n, "psm", a, b - a, "<P>" + text[:a] + "<S>" + text[b:] + "<M>" + text[a:b]


def chunked(text):
    data = text.encode()
    (_, marks), = M.groups([data])
    return M.Chunked(data, marks[0], M.Summaries())


def test_query(spark, documents, sf_dir):
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op13_fill_middle_chunks"](spark, sf_dir).collect()}
    assert len(got) == len(documents)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for doc_id, text in documents:
        n, form, a, m, output = plain(doc_id, text)
        assert got[doc_id] == (n, form, a, m, sha(output), sha(text or "")), doc_id


def test_odd_rows(spark, odd_documents, no_documents):
    rows = M.transformed(odd_documents).select("*", M.restored("output", "form").alias("back")).collect()
    wanted = sorted((plain(r.doc_id, r.text) + (r.text or "",) for r in odd_documents.collect()), key=str)
    assert sorted((tuple(r)[1:] for r in rows), key=str) == wanted
    assert M.transformed(no_documents).collect() == []


@settings(max_examples=80, deadline=None)
@given(st.lists(st.sampled_from(WORDS), max_size=120).map("".join), st.integers(1, 40))
def test_chunks_add_up(text, repeat):
    text = text * repeat
    own = chunked(text)
    assert own.length == len(text)
    assert own.has_sentinel == any(s in text for s in ("<P>", "<S>", "<M>"))
    for point in {0, len(text) // 3, len(text) // 2, len(text)}:
        assert own.data[: own.byte_of(point)].decode() == text[:point]


def test_sentinel_over_a_border_shows():
    joined = M.Summaries().joined
    one = M.Summaries()
    for cut in range(1, 3):
        for sentinel in ("<P>", "<S>", "<M>"):
            text = f"ab{sentinel}cd".encode()
            at = 2 + cut
            assert not one.of(text[:at])[1] and not one.of(text[at:])[1]
            assert joined(one.of(text[:at]), one.of(text[at:]))[1]
    parts = [one.of(x) for x in (b"<", b"P", b">")]
    assert joined(joined(parts[0], parts[1]), parts[2])[1] and joined(parts[0], joined(parts[1], parts[2]))[1]


@pytest.mark.parametrize("unit", ["x", "é", "日本"])
def test_long_texts_without_a_mark(unit):
    text = unit * 60000
    own = chunked(text)
    assert own.length == len(text) and max(b - a for a, b in zip([0, *own.ends], own.ends)) <= M.LONGEST
    assert own.data[: own.byte_of(50001)].decode() == text[:50001]


def test_shared_passages_fall_into_equal_chunks():
    passage = "".join(hashlib.sha256(str(i).encode()).hexdigest() for i in range(400))
    chunks = [set(), set()]
    for k, head in enumerate(("one", "another beginning, longer")):
        data = (head + passage).encode()
        (_, marks), = M.groups([data])
        ends = M.bounds(data, marks[0])
        chunks[k] = {data[a:b] for a, b in zip([0, *ends], ends)}
    shared = sum(map(len, chunks[0] & chunks[1]))
    assert shared > 0.8 * len(passage)


def test_texts_hashed_together_are_cut_as_if_alone():
    texts = [(hashlib.sha256(str(i).encode()).hexdigest() * 90).encode() for i in range(5)]
    texts = [b"", *texts, b"short"]
    together = [own for _, marks in M.groups(texts) for own in marks]
    assert together == [own for t in texts for _, marks in M.groups([t]) for own in marks]


def test_cache_is_bounded(monkeypatch):
    monkeypatch.setattr(M, "CACHED", 100)
    own = M.Summaries()
    for i in range(50):
        own.of(str(i).encode() * 10)
        assert sum(map(len, own.held)) <= 100
