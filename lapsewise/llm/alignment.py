"""Alignment of two tokenizers, with corpus-wide counts of token pairs from inverted bitmaps.

Tokenizer A is a byte-level BPE file of the ``tokenizers`` library and reads a space and the text, with
special tokens spelled as plain text (characters of long standing are merged by ``tiktoken`` from the same file, with
the same ids); B is a ``sentencepiece`` model that adds the space itself. A
token's bytes tell where it ends. Ends that both sides share cut a document into groups, and
an occurrence of A and one of B are linked if their byte ranges overlap.

Documents are dealt into blocks as tasks read them. For each pair of ids a block holds a bitmap of the
documents that link it, and planes: plane k has the documents whose number of further links has bit k. A bitmap
is a sorted list of 16-bit places or plain bits, whichever is smaller. Popcounts give a pair's
documents and links, added over the blocks; the postings meet the pairs' scores in one join and hand them back
to the documents of their block.

Texts that are null or empty, and those whose tokens don't spell the space and the text (B normalises or
drops something), have no tokens: zeros and an empty group column. Repeated rows are documents of their
own, null keys pass through, extra columns are ignored, an empty table gives an empty one. A text
is held whole by the task that reads its row, with all its links; a block closes at MOST_LINKS links.
"""

import hashlib
import json
import os
import re
import sys
import unicodedata
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lapsewise.llm.arrays import gathered, ranges, worker_state
from lapsewise.llm.bpe import byte_alphabet
from lapsewise.sources.workspace import materialise

# executors unpickle the helpers below without having this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Bytes of texts that are aligned together.
TOGETHER = 1 << 20
#: A block of documents closes at that many links, or documents.
MOST_LINKS, MOST_DOCUMENTS = 8_000_000, 1 << 16
#: Bits of an id of B in a pair's number.
B_BITS = 24
#: Rows of a returned batch; dense bitmaps unpacked together.
RETURNED, UNPACKED = 1 << 16, 1 << 10
#: Words and blanks from here on go to the library's own merging, which is not quadratic in them.
LONG_WORD = 512
BLANK = re.compile(r"\s{%d}" % LONG_WORD)
# Fixed value: how a byte-level pre-tokenizer of that file format splits a text.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Plane number of the bitmap of all documents that hold a pair.
ALL = -1


def by_ranks(file: dict):
    """The same merges in ``tiktoken``, which is faster: where every merge makes the next id, ids are ranks. Else None."""
    import tiktoken

    model, split = file["model"], file.get("pre_tokenizer") or {}
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    letters, vocab = byte_alphabet(), model["vocab"]
    special = {t["content"] for t in file.get("added_tokens", [])}
    made = [*sorted(letters, key=lambda c: vocab.get(c, -1)), *("".join(m) for m in merges)]
    odd = any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
    plain = split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space")
    if odd or not plain or file.get("normalizer") or [vocab.get(t) for t in made] != [*range(len(made))] or set(vocab) - set(made) - special:
        return None
    byte_of = {c: b for b, c in enumerate(letters)}
    ranks = {bytes(byte_of[c] for c in t): i for i, t in enumerate(made)}
    return tiktoken.Encoding("a", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})


def known_characters() -> str:
    """A character class of what all versions of Unicode since 3.2 sort alike, so that both libraries split it alike."""
    old, new = unicodedata.ucd_3_2_0.category, unicodedata.category
    same = [old(c)[0] == new(c)[0] != "C" or c in "\t\n\r" for c in map(chr, range(sys.maxunicode + 1))]
    start, end = ranges(np.array(same))
    return "".join(f"\\U{a:08x}-\\U{b - 1:08x}" for a, b in zip(start.tolist(), end.tolist()))


class Side:
    """The bytes of each token, end to end, and where they start."""

    def __init__(self, tokens: list[bytes]):
        self.flat = np.frombuffer(b"".join(tokens), np.uint8)
        self.edge = np.cumsum([0, *map(len, tokens)])
        self.size = np.diff(self.edge)

    def spelled(self, ids):
        return gathered(self.flat, self.edge[ids], self.edge[ids + 1])[0]


class Pair:
    """Both tokenizers of a worker."""

    def __init__(self, spec: str, model: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(spec)
        self.same_merges = by_ranks(json.loads(spec))
        self.known = re.compile(f"[{known_characters()}]*") if self.same_merges else None
        self.library.encode_special_tokens = True
        self.library.no_truncation()
        self.library.no_padding()
        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=model)
        byte_of = {c: b for b, c in enumerate(byte_alphabet())}
        names = {i: t for t, i in self.library.get_vocab(with_added_tokens=True).items()}
        a = [names.get(i, "") for i in range(max(names) + 1)]
        self.a = Side([bytes(byte_of[c] for c in t) if all(c in byte_of for c in t) else t.encode() for t in a])
        get = self.pieces
        self.b = Side([
            bytes([int(get.id_to_piece(i)[3:5], 16)]) if get.is_byte(i) else get.id_to_piece(i).replace("▁", " ").encode()
            for i in range(get.get_piece_size())
        ])
        most = max(len(self.a.size), len(self.b.size))
        # decimal ids followed by one of three marks, for the text of the groups
        self.most, self.digits = most, Side([f"{i}{mark}".encode() for mark in ",|;" for i in range(most)])

    def encoded(self, texts: list[str]) -> tuple:
        """Ids of A and of B of all texts, end to end, and how many each text has."""
        a = self.ids_of_a([" " + t for t in texts])
        b = self.pieces.encode(texts, num_threads=1)
        flat = lambda rows: np.fromiter(chain.from_iterable(rows), np.int64)
        return flat(a), np.array([*map(len, a)]), flat(b), np.array([*map(len, b)])

    def ids_of_a(self, texts: list[str]) -> list[list[int]]:
        out, others = [None] * len(texts), []
        for i, text in enumerate(texts):
            if self.same_merges and self.known.fullmatch(text) and max(map(len, text.split()), default=0) < LONG_WORD and not BLANK.search(text):
                out[i] = self.same_merges.encode_ordinary(text)
            else:
                others.append(i)
        if others:
            for i, found in zip(others, self.library.encode_batch_fast([texts[i] for i in others], add_special_tokens=False)):
                out[i] = found.ids
        return out

    def aligned(self, texts: list[str]) -> tuple[list[tuple], tuple]:
        """(n_a, n_b, n_groups, n_links, groups_sha256) of each text; and A's id, B's id and text number of each link."""
        a, n_a, b, n_b = self.encoded(texts)
        raw = [b" " + t.encode("utf-8", "surrogatepass") for t in texts]
        size = np.array([*map(len, raw)])
        good = np.array([t != "" for t in texts])
        for side, ids, n in ((self.a, a, n_a), (self.b, b, n_b)):
            spelled = side.spelled(ids)
            edge = np.concatenate([[0], np.cumsum(side.size[ids])])[np.concatenate([[0], np.cumsum(n)])]
            good &= np.diff(edge) == size
            for i in np.flatnonzero(good):
                good[i] = spelled[edge[i] : edge[i + 1]].tobytes() == raw[i]
        a, b = a[np.repeat(good, n_a)], b[np.repeat(good, n_b)]
        n_a, n_b, size = n_a * good, n_b * good, size * good
        end_a, end_b, stop = np.cumsum(self.a.size[a]), np.cumsum(self.b.size[b]), np.cumsum(size)
        at_a, at_b = (np.zeros(int(stop[-1]) + 1, bool) for _ in "ab")
        at_a[end_a], at_b[end_b] = True, True
        ends, common = np.flatnonzero(at_a | at_b), at_a & at_b
        # how many tokens end before each end is the number of the one that holds the bytes up to it
        of_a, of_b = np.cumsum(at_a)[ends] - at_a[ends], np.cumsum(at_b)[ends] - at_b[ends]
        n_links, n_groups = (np.diff(np.cumsum(marks)[stop], prepend=0) for marks in (at_a | at_b, common))
        digests = self._group_digests(a, b, end_a, end_b, common, n_a, n_b)
        rows = [(*x, d if ok else "") for *x, d, ok in zip(n_a.tolist(), n_b.tolist(), n_groups.tolist(), n_links.tolist(), digests, good)]
        return rows, (a[of_a], b[of_b], np.repeat(np.arange(len(texts)), n_links))

    def _group_digests(self, a, b, end_a, end_b, common, n_a, n_b) -> list[str]:
        last_a, last_b = common[end_a], common[end_b]
        # of a group first the tokens of A, then those of B: so many of the other side stand before a token
        before_a, before_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        upto_a, upto_b = (np.concatenate([[0], np.flatnonzero(last) + 1]) for last in (last_a, last_b))
        place_a, place_b = np.arange(len(a)) + upto_b[before_a], np.arange(len(b)) + upto_a[before_b + 1]
        tokens = np.empty(len(a) + len(b), np.int64)
        tokens[place_a], tokens[place_b] = a + self.most * last_a, b + 2 * self.most * last_b
        edge = np.concatenate([[0], np.cumsum(self.digits.size[tokens])])[np.concatenate([[0], np.cumsum(n_a + n_b)])]
        text = self.digits.spelled(tokens).tobytes()
        # without the mark after the last group
        return [hashlib.sha256(text[x : max(x, y - 1)]).hexdigest() for x, y in zip(edge.tolist(), edge[1:].tolist())]


def pair_of(spec: str, model: bytes) -> Pair:
    """One for each worker process and pair of files; it outlives the tasks of a reused worker."""
    held = worker_state("tokenizer_pairs")
    name = hashlib.sha256(spec.encode() + model).digest()
    if name not in held:
        held[name] = Pair(spec, model)
    return held[name]


class Block:
    """The links of some documents; closed, the bitmaps of their pairs."""

    def __init__(self, number: int):
        self.number, self.documents, self.links, self.parts = number, 0, 0, []

    def add(self, documents: int, a, b, which) -> None:
        pair = a << B_BITS | b
        self.parts.append(pair << 16 | (which + self.documents))
        self.documents += documents
        self.links += len(a)

    def bitmaps(self) -> Iterator[tuple]:
        """(pair, plane, dense, start, stop, bytes) arrays; start and stop are the bitmap's place in the bytes."""
        key, times = np.unique(np.concatenate(self.parts), return_counts=True)
        yield self._plane(ALL, key)
        further, plane = times - 1, 0
        while (further >> plane).any():
            yield self._plane(plane, key[further >> plane & 1 == 1])
            plane += 1

    def _plane(self, plane: int, key) -> tuple:
        pair, place = key >> 16, key & 0xFFFF
        first = np.flatnonzero(np.diff(pair, prepend=-1))
        count = np.diff(first, append=len(pair))
        width = (self.documents + 7) // 8
        dense = 2 * count > width
        size = np.where(dense, width, 2 * count)
        stop = np.cumsum(size)
        out = np.zeros(int(stop[-1]) if len(stop) else 0, np.uint8)
        start = stop - size
        of = np.repeat(np.arange(len(first)), count)
        nth = np.arange(len(pair)) - np.repeat(first, count)
        sparse = ~dense[of]
        at = start[of[sparse]] + 2 * nth[sparse]
        out[at], out[at + 1] = place[sparse] & 255, place[sparse] >> 8
        at = start[of[~sparse]] + (place[~sparse] >> 3)
        np.bitwise_or.at(out, at, (1 << (place[~sparse] & 7)).astype(np.uint8))
        return pair[first], np.full(len(first), plane, np.int32), dense, start, stop, out


FOUND = "_block long, _place int, _n_a long, _n_b long, _n_groups long, _n_links long, _groups string, _pair long, _plane int, _dense boolean, _bits binary"


def document_rows(block: Block, keys: pa.Array, rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    n = len(rows)
    place = np.arange(block.documents, block.documents + n, dtype=np.int32)
    counts = [pa.array(c, pa.int64()) for c in zip(*(r[:4] for r in rows))]
    empty = [pa.nulls(n, t) for t in (pa.int64(), pa.int32(), pa.bool_(), pa.binary())]
    return pa.RecordBatch.from_arrays(
        [keys, pa.array(np.full(n, block.number)), pa.array(place), *counts, pa.array([r[4] for r in rows], pa.string()), *empty], names
    )


def posting_rows(block: Block, key_type: pa.DataType, names: list[str]) -> Iterator[pa.RecordBatch]:
    for pair, plane, dense, start, stop, data in block.bitmaps() if block.links else ():
        for at in range(0, len(pair), RETURNED):
            cut = slice(at, at + RETURNED)
            n, low = len(pair[cut]), int(start[at])
            offsets = np.concatenate([start[cut] - low, [stop[cut][-1] - low]]).astype(np.int32)
            own = data[low : int(stop[cut][-1])]
            bits = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(own.tobytes())])
            empty = [pa.nulls(n, t) for t in (pa.int32(), *[pa.int64()] * 4, pa.string())]
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(n, key_type), pa.array(np.full(n, block.number)), *empty, pa.array(pair[cut]), pa.array(plane[cut]), pa.array(dense[cut]), bits], names
            )


def together(texts: list[str]) -> Iterator[slice]:
    """Neighbouring texts of about TOGETHER characters."""
    at = size = 0
    for i, text in enumerate(texts):
        if i > at and size + len(text) > TOGETHER:
            yield slice(at, i)
            at, size = i, 0
        size += len(text)
    if at < len(texts):
        yield slice(at, len(texts))


def indexed(docs: DataFrame, a_path: str, b_path: str, key: str, text: str) -> DataFrame:
    """The rows of documents and of postings of all blocks, in one written table."""
    with open(a_path, encoding="utf-8") as file:
        spec = file.read()
    with open(b_path, "rb") as file:
        files = docs.sparkSession.sparkContext.broadcast((spec, file.read()))  # the sizes of two vocabulary files
    source = docs.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{text}`").alias("_text"))
    schema = T.StructType([T.StructField("_key", source.schema["_key"].dataType), *T.StructType.fromDDL(FOUND)])
    names = schema.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        tokenizers, task, key_type = pair_of(*files.value), TaskContext.get().partitionId(), None
        block = Block(task << 32)
        for batch in batches:
            keys, key_type = batch.column(0), batch.schema.field(0).type
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for cut in together(texts):
                for lower in range(cut.start, cut.stop, MOST_DOCUMENTS // 2):
                    part = slice(lower, min(cut.stop, lower + MOST_DOCUMENTS // 2))
                    rows, (a, b, which) = tokenizers.aligned(texts[part])
                    if block.links and (block.links + len(a) > MOST_LINKS or block.documents + len(rows) > MOST_DOCUMENTS):
                        yield from posting_rows(block, key_type, names)
                        block = Block(block.number + 1)
                    elif block.documents + len(rows) > MOST_DOCUMENTS:
                        block = Block(block.number + 1)
                    yield document_rows(block, keys.slice(part.start, part.stop - part.start), rows, names)
                    block.add(len(rows), a, b, which)
        if block.links:
            yield from posting_rows(block, key_type, names)

    return materialise(source.mapInArrow(run, schema), "postings")


def pair_scores(postings: DataFrame) -> DataFrame:
    """_pair, docs, links, and best: whether no pair with this id of B has more links."""
    count = F.when(F.col("_dense"), F.bitmap_count("_bits")).otherwise(F.octet_length("_bits") / 2).cast("long")
    weight = F.when(F.col("_plane") == ALL, 1).otherwise(F.expr("shiftleft(1L, _plane)"))
    each = postings.select("_pair", (count * weight).alias("links"), F.when(F.col("_plane") == ALL, count).otherwise(0).alias("docs"))
    pairs = materialise(each.groupBy("_pair").agg(F.sum("docs").alias("docs"), F.sum("links").alias("links")), "pairs")
    pairs = pairs.withColumn("_b", F.col("_pair").bitwiseAND((1 << B_BITS) - 1))
    top = pairs.groupBy("_b").agg(F.max("links").alias("_top"))
    return pairs.join(top, "_b").select("_pair", "docs", "links", (F.col("links") == F.col("_top")).alias("best"))


class Sums:
    """Sums of links, scores and documents for each place of each block."""

    def __init__(self):
        self.blocks: dict[int, np.ndarray] = {}

    def add(self, block: int, place, row, weight, links, docs, best) -> None:
        own = self.blocks.get(block)
        need = int(place.max()) + 1
        if own is None or own.shape[1] < need:
            grown = np.zeros((3, max(need, 0 if own is None else 2 * own.shape[1])), np.int64)
            if own is not None:
                grown[:, : own.shape[1]] = own
            self.blocks[block] = own = grown
        for i, score in enumerate((best, links, docs)):
            np.add.at(own[i], place, (weight * score)[row])


def returned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of postings with their pair's scores in; sums for each document out."""
    sums = Sums()
    for batch in batches:
        block, plane, dense, links, docs, best = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1, 2, 4, 5, 6))
        bits = batch.column(3)
        width = np.diff(np.frombuffer(bits.buffers()[1], np.int32, len(bits) + 1, 4 * bits.offset))
        data = np.frombuffer(bits.buffers()[2], np.uint8) if bits.buffers()[2] else np.zeros(0, np.uint8)
        start = np.frombuffer(bits.buffers()[1], np.int32, len(bits), 4 * bits.offset).astype(np.int64)
        weight = np.where(plane == ALL, 1, 1 << np.maximum(plane, 0).astype(np.int64))
        for number in np.unique(block).tolist():
            scores = (weight, links, docs, best.astype(np.int64))
            own = np.flatnonzero((block == number) & ~dense)
            if len(own):
                flat, size = gathered(data, start[own], start[own] + width[own])
                sums.add(number, flat.view("<u2").astype(np.int64), np.repeat(own, size // 2), *scores)
            own = np.flatnonzero((block == number) & dense)
            for at in range(0, len(own), UNPACKED):
                some = own[at : at + UNPACKED]
                flat, size = gathered(data, start[some], start[some] + width[some])
                row, place = np.nonzero(np.unpackbits(flat.reshape(len(some), -1), axis=1, bitorder="little"))
                sums.add(number, place, some[row], *scores)
    names = ["_block", "_place", "_best", "_count_sum", "_docs_sum"]
    for number, own in sums.blocks.items():
        place = np.flatnonzero(own[1])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(place), number)), pa.array(place.astype(np.int32)), *(pa.array(x[place]) for x in own)], names
        )


def aligned(docs: DataFrame, a_path: str, b_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256; and docs_sum, the pairs' documents summed over links."""
    found = indexed(docs, a_path, b_path, key, text)
    postings = found.where("_pair IS NOT NULL").select("_block", "_pair", "_plane", "_dense", "_bits")
    scored = postings.join(pair_scores(postings), "_pair")
    scored = scored.select("_block", "_plane", "_dense", "_bits", "links", "docs", "best").repartition("_block")
    sums = scored.mapInArrow(returned, "_block long, _place int, _best long, _count_sum long, _docs_sum long")
    own = found.where("_place IS NOT NULL").drop("_pair", "_plane", "_dense", "_bits")
    rows = own.join(sums, ["_block", "_place"], "left")
    got = lambda c: F.coalesce(c, F.lit(0).cast("long"))
    return rows.select(
        F.col("_key").alias(key), F.col("_n_a").alias("n_a"), F.col("_n_b").alias("n_b"), F.col("_n_groups").alias("n_groups"), F.col("_n_links").alias("n_links"),
        got("_best").alias("n_best"), got("_count_sum").alias("count_sum"), F.col("_groups").alias("groups_sha256"), got("_docs_sum").alias("docs_sum"),
    )
