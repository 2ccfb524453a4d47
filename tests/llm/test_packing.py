"""First-fit against a plain loop; packed documents against the library's ids."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import Row
from tokenizers import Tokenizer as Library

from lapsewise.llm import packing
from lapsewise.llm.queries import QUERIES, TOKENIZER


def test_first_fit_equals_a_plain_loop():
    rng = random.Random(3)
    tree, free = packing.FirstFit(100), []
    for _ in range(2000):
        length = rng.randint(1, 100)
        wanted = next((i for i, room in enumerate(free) if room >= length), len(free))
        if wanted == len(free):
            free.append(100)
        assert tree.place(length) == (wanted, 100 - free[wanted])
        free[wanted] -= length


def check(rows, ids, capacity=4096):
    filled, pieces = defaultdict(list), defaultdict(list)
    for r in rows:
        filled[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id].append(r)
    for parts in filled.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end and length > 0
            end += length
        assert end <= capacity
    for doc_id, texts in ids.items():
        n = 0
        for r in pieces[doc_id]:
            assert any(
                r.doc_tokens == len(own) and zlib.crc32(np.array(own[r.start : r.start + r.length], "<u4").tobytes()) == r.ids_crc32
                for own in texts
            )
            n += r.length
        assert n == sum(map(len, texts))
    return len(filled)


def library_ids(rows):
    own, out = Library.from_file(TOKENIZER), defaultdict(list)
    for doc_id, text in rows:
        out[doc_id].append(own.encode(text or "", add_special_tokens=False).ids + [2])
    return out


def test_query(spark, sf_dir, documents):
    rows = QUERIES["op1_pack_first_fit"](spark, sf_dir).collect()
    ids = library_ids(documents)
    sequences = check(rows, ids)
    total = sum(len(x) for own in ids.values() for x in own)
    assert total / (4096 * sequences) > 0.97


def test_odd_documents(spark, odd_documents, no_documents):
    rows = packing.pack_documents(odd_documents, TOKENIZER, capacity=64).collect()
    check(rows, library_ids([(r.doc_id, r.text) for r in odd_documents.collect()]), 64)
    assert packing.pack_documents(no_documents, TOKENIZER).collect() == []


def test_groups_are_independent_and_repeatable(spark):
    pieces = spark.range(3000).selectExpr("id", "1 + pmod(xxhash64(id), 300) AS length")
    place = lambda: packing.place(pieces, ["id"], 300, group_pieces=100)
    first, again = ({r.id: (r.sequence_id, r.offset) for r in place().collect()} for _ in range(2))
    assert first == again and len({s >> 32 for s, _ in first.values()}) == 30


def test_equal_pieces_spread(spark):
    """Nine of ten rows are one piece without a key: they fill many groups, none much above its size."""
    pieces = spark.range(20000).selectExpr("CASE WHEN id % 10 = 0 THEN id END AS id", "IF(id % 10 = 0, 1 + id % 90, 7) AS length")
    rows = packing.place(pieces, ["id"], 100, group_pieces=200).collect()
    assert check([Row(doc_id=r.id, start=0, length=r.length, sequence_id=r.sequence_id, offset=r.offset) for r in rows], {}, 100) > 0
    sizes = Counter(r.sequence_id >> 32 for r in rows)
    assert len(rows) == 20000 and len(sizes) == 100 and max(sizes.values()) < 400


def test_sequences(spark, no_documents):
    pieces = spark.createDataFrame([(7, 4, 8, bytes(8), 2), (7, 0, 3, b"abcd" * 4, 4)], "sequence_id long, offset long, x int, ids binary, length long")
    assert [tuple(r) for r in packing.sequences(pieces).collect()] == [(7, b"abcd" * 4 + bytes(8), 6)]
