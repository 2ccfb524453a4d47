"""Groups, links and pair counts against a plain version."""

import hashlib
import json
from bisect import bisect_left
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from lapsewise.llm import alignment as A
from lapsewise.llm.bpe import byte_alphabet
from lapsewise.llm.queries import ALIGNED, QUERIES

BYTE_OF = {c: b for b, c in enumerate(byte_alphabet())}


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(ALIGNED[0])
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=ALIGNED[1])


def ranges(ids, sizes):
    at = 0
    for i, n in zip(ids, sizes):
        yield i, at, at + n
        at += n


def links_of(text, libraries):
    """(n_a, n_b, groups as text, list of linked id pairs) of one text, by comparing ranges."""
    a_lib, b_lib = libraries
    if not text:
        return 0, 0, None, []
    a = a_lib.encode(" " + text, add_special_tokens=False)
    b = b_lib.encode(text)
    raw_a = [bytes(BYTE_OF[c] for c in t) for t in a.tokens]
    raw_b = [bytes([int(p[3:5], 16)]) if b_lib.is_byte(i) else p.replace("▁", " ").encode() for i, p in ((i, b_lib.id_to_piece(i)) for i in b)]
    if not b"".join(raw_a) == b"".join(raw_b) == (" " + text).encode():
        return 0, 0, None, []
    a_at, b_at = list(ranges(a.ids, map(len, raw_a))), list(ranges(b, map(len, raw_b)))
    links, k = [], 0
    for i, start, end in a_at:
        while b_at[k][2] <= start:
            k += 1
        j = k
        while j < len(b_at) and b_at[j][1] < end:
            links.append((i, b_at[j][0]))
            j += 1
    both = sorted({e for *_, e in a_at} & {e for *_, e in b_at})
    sides = [[[], []] for _ in both]
    for k, rows in enumerate((a_at, b_at)):
        for i, _, end in rows:
            sides[bisect_left(both, end)][k].append(str(i))
    groups = ["|".join(map(",".join, pair)) for pair in sides]
    return len(a_at), len(b_at), ";".join(groups), links


def plain(rows, libraries):
    found = [(i, *links_of(t, libraries)) for i, t in rows]
    counts, docs, top = Counter(), Counter(), Counter()
    for *_, links in found:
        counts.update(links)
        docs.update(set(links))
    for (_, b), n in counts.items():
        top[b] = max(top[b], n)
    return [
        (i, n_a, n_b, groups.count(";") + 1 if groups else 0, len(links), sum(counts[x] == top[x[1]] for x in links), sum(counts[x] for x in links),
         hashlib.sha256(groups.encode()).hexdigest() if groups else "", sum(docs[x] for x in links))
        for i, n_a, n_b, groups, links in found
    ]


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: (r[0] is not None, r[0] or 0, *r[1:]))


def test_query(spark, documents, sf_dir, libraries):
    got = ordered(QUERIES["op12_alignment_bitmaps"](spark, sf_dir).collect())
    assert got == ordered(plain(documents, libraries))
    assert {r[4] for r in got} != {0}


ODD = [
    "", None, " ", "a", "a  b", "\n\n", "\t", "foo<|endoftext|>bar</s><s>", "▁", "x▁y", "é日本🎉", "ﬁ ² ½", "a\x00b", "tab\there", "word " * 3000, "<0x41>", "a", "a", "  lead",
]


def test_odd_rows(spark, odd_documents, no_documents, libraries):
    rows = [(None if i % 7 == 3 else i, t) for i, t in enumerate(ODD)]
    table = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, n_a string, _pair int").repartition(3)
    assert ordered(A.aligned(table, *ALIGNED).collect()) == ordered(plain(rows, libraries))
    odd = [(r.doc_id, r.text) for r in odd_documents.collect()]
    assert ordered(A.aligned(odd_documents, *ALIGNED).collect()) == ordered(plain(odd, libraries))
    assert A.aligned(no_documents, *ALIGNED).collect() == []


def test_blocks_add_up(spark, documents, libraries, monkeypatch):
    rows = sorted(documents, key=lambda r: len(r[1] or ""))[:60]
    wanted = ordered(plain(rows, libraries))
    monkeypatch.setattr(A, "MOST_LINKS", 2000)
    monkeypatch.setattr(A, "TOGETHER", 1500)
    table = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    found = A.indexed(table, *ALIGNED, "doc_id", "text")
    assert found.select("_block").distinct().count() > 5
    assert ordered(A.aligned(table, *ALIGNED).collect()) == wanted


def test_bitmaps_hold_documents_and_multiplicities():
    rng = np.random.default_rng(3)
    a, b, which = rng.integers(0, 6, 5000), rng.integers(0, 4, 5000), np.sort(rng.integers(0, 300, 5000))
    block = A.Block(7)
    block.add(200, a[which < 200], b[which < 200], which[which < 200])
    block.add(100, a[which >= 200], b[which >= 200], which[which >= 200] - 200)
    wanted = Counter(zip(a.tolist(), b.tolist(), which.tolist()))
    got, kinds = Counter(), set()
    for pair, plane, dense, start, stop, data in block.bitmaps():
        for p, k, d, x, y in zip(pair.tolist(), plane.tolist(), dense.tolist(), start.tolist(), stop.tolist()):
            bits = np.unpackbits(data[x:y], bitorder="little") if d else None
            places = np.flatnonzero(bits) if d else data[x:y].view("<u2")
            kinds.add(d)
            got.update({(p >> A.B_BITS, p & (1 << A.B_BITS) - 1, int(i)): 1 if k == A.ALL else 1 << k for i in places})
    assert got == wanted and kinds == {True, False}


def test_both_libraries_of_a_agree(libraries):
    """On every character that goes to the faster one, between letters, digits, blanks and others of its kind."""
    with open(ALIGNED[0], encoding="utf-8") as a, open(ALIGNED[1], "rb") as b:
        own = A.Pair(a.read(), b.read())
    known = [c for c in map(chr, range(0x110000)) if own.known.fullmatch(c)]
    assert len(known) > 90_000 and {"a", "é", "日", "\n", "\u3000"} <= set(known) and not {"\x85", "\u200b", "\x1c"} & set(known)
    texts = [f"a{c}b {c}{c}1{c}!{c}  {c}\n{c}" for c in known] + ["x" * 5000, " " * 5000, "it's I'll 'S", "\r\n\t \n x"]
    wanted = [e.ids for e in own.library.encode_batch_fast(texts, add_special_tokens=False)]
    assert [own.same_merges.encode_ordinary(t) for t in texts] == wanted
    assert own.ids_of_a(texts) == wanted


def test_other_files_are_left_to_the_library():
    with open(ALIGNED[0], encoding="utf-8") as file:
        spec = json.load(file)
    assert A.by_ranks(spec) is not None
    assert A.by_ranks(spec | {"normalizer": {"type": "NFC"}}) is None
    merges = spec["model"]["merges"]
    assert A.by_ranks(spec | {"model": spec["model"] | {"merges": [merges[1], merges[0], *merges[2:]]}}) is None
