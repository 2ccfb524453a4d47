"""Byte-pair encoding by forced-boundary splitting, and decoding.

Two neighbouring bytes that never stand side by side inside any token of the vocabulary can never
be merged, so the border between them is a certain cut. Words are cut there, the fragments are
merged independently of each other and their ids are concatenated. All fragments of a batch are
merged together as arrays.

It reads tokenizer files of the ``tokenizers`` library with a BPE model over byte-level words that
are split at white space (white space itself gives no token), and gives the ids that the library
gives with ``add_special_tokens=False``. The text of a special token becomes that token; the text around it
is encoded like any other. Special tokens that strip, need a whole word or match normalised text are an error.

A null text counts as empty: no ids, and the empty string when decoded. Rows are never dropped or
merged; other columns, repeated rows and null ids of documents pass through unchanged.
"""

import json
import re
import sys
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from lapsewise.llm.arrays import ascii_space, distinct, gathered, ranges, worker_state

# executors unpickle the helpers below without having this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

NONE = np.iinfo(np.int32).max
#: Texts that a worker returns at once.
RETURNED = 256
#: Bytes of texts that are encoded together; bounds the worker's memory, not the text.
TOGETHER = 1_000_000


def byte_alphabet() -> list[str]:
    """The character that stands for each byte: itself if printable, else one from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


class Codec:
    def __init__(self, spec: str):
        from tokenizers import Tokenizer

        model = json.loads(spec)["model"]
        self.library = Tokenizer.from_str(spec)
        self.library.no_truncation()
        self.library.no_padding()
        self.tokens = {i: t for t, i in self.library.get_vocab(with_added_tokens=True).items()}
        vocab, suffix = model["vocab"], model.get("end_of_word_suffix") or ""
        letters = byte_alphabet()
        self.byte_of = {c: b for b, c in enumerate(letters)}
        self.first_ids = np.array([vocab[c] for c in letters] + [vocab[c + suffix] for c in letters], np.int64)
        self._index_merges([tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]], vocab)
        self._index_inside(vocab, suffix)
        added = json.loads(spec)["added_tokens"]
        if any(t[flag] for t in added for flag in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError("added tokens have to match raw text as it stands")
        self.special_ids = {t["content"]: np.array([t["id"]], "<u4").tobytes() for t in added}
        self.specials = re.compile("(" + ("|".join(map(re.escape, sorted(self.special_ids, key=len, reverse=True))) or r"(?!)") + ")")
        # Below U+0180 categories are stable, lower case stays below (but for one letter) and nothing is composed.
        low = [chr(c) for c in range(0x180)]
        inside = lambda kind: "".join(re.escape(c) for c in low if unicodedata.category(c)[0] == kind)
        # Its white space beyond ASCII, and the separators U+001C to U+001F, are left to the library's own splitting.
        self.plain = re.compile("[\0-\x1b\x20-\x84\x86-\x9f\xa1-įı-ſ]*")
        self.words = re.compile(f"\n|'s|'t|'re|'ve|'m|'ll|'d|[{inside('L')}]+|[{inside('N')}]|[^\n{inside('L')}{inside('N')}]+")
        self.space = ascii_space()

    def _index_merges(self, merges, vocab) -> None:
        left = np.array([vocab[a] for a, _ in merges], np.uint64)
        right = np.array([vocab[b] for _, b in merges], np.uint64)
        self.merged = np.array([vocab[a + b] for a, b in merges], np.int64)
        made = {int(i): r for r, i in enumerate(self.merged)}
        # if every token comes from one merge, and from parts made before it, all places of the
        # best pair can be merged at once
        self.in_order = len(made) == len(merges) and all(
            made.get(int(a), -1) < r and made.get(int(b), -1) < r for r, (a, b) in enumerate(zip(left, right))
        )
        self.bits = 20
        self.keys = np.full(1 << self.bits, NONE, np.uint64)
        self.ranks = np.full(1 << self.bits, NONE, np.int32)
        keys = left << np.uint64(17) | right
        for rank, (key, slot) in enumerate(zip(keys.tolist(), self._slots(keys).tolist())):
            while self.ranks[slot] != NONE:
                slot = (slot + 1) % len(self.keys)
            self.keys[slot], self.ranks[slot] = key, rank

    def _slots(self, keys):
        return (keys * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.bits)).astype(np.int64)

    def _rank(self, a, b):
        keys = a.astype(np.uint64) << np.uint64(17) | b.astype(np.uint64)
        slots = self._slots(keys)
        found = self.keys[slots]
        out = np.where(found == keys, self.ranks[slots], NONE)
        open_ = np.flatnonzero((found != keys) & (found != NONE))
        while len(open_):
            slots[open_] = (slots[open_] + 1) % len(self.keys)
            found = self.keys[slots[open_]]
            hit = found == keys[open_]
            out[open_[hit]] = self.ranks[slots[open_[hit]]]
            open_ = open_[~hit & (found != NONE)]
        return out

    def _index_inside(self, vocab, suffix) -> None:
        """Which byte may be followed, inside a token, by which byte; from 256 on: by which last byte of a word."""
        self.inside = np.zeros((256, 512), bool)
        for token in vocab:
            ends = bool(suffix) and token.endswith(suffix)
            raw = [self.byte_of[c] for c in (token[: -len(suffix)] if ends else token) if c in self.byte_of]
            for i in range(1, len(raw)):
                self.inside[raw[i - 1], raw[i] + 256 * (ends and i == len(raw) - 1)] = True

    def _merge(self, symbols, starts):
        """Ids after all merges at the place of their first byte, elsewhere -1."""
        out = np.full(len(symbols), -1, np.int32)
        place, fragment = np.arange(len(symbols), dtype=np.int32), np.cumsum(starts, dtype=np.int32)
        rank = np.full(len(symbols), NONE, np.int32)  # of each symbol with the next one
        pairs = np.flatnonzero(fragment[1:] == fragment[:-1])
        rank[pairs] = self._rank(symbols[pairs], symbols[pairs + 1])
        while len(symbols):
            first = np.flatnonzero(np.diff(fragment, prepend=-1))
            best = np.minimum.reduceat(rank, first)
            size = np.diff(first, append=len(symbols))
            done = np.repeat(best == NONE, size)
            hit = np.flatnonzero((rank == np.repeat(best, size)) & ~done)
            if self.in_order:  # of overlapping places, every other one from the left
                run = np.maximum.accumulate(np.where(np.diff(hit, prepend=-2) != 1, np.arange(len(hit)), 0))
                hit = hit[(np.arange(len(hit)) - run) % 2 == 0]
            else:
                hit = hit[np.unique(fragment[hit], return_index=True)[1]]
            out[place[done]] = symbols[done]
            symbols[hit] = self.merged[rank[hit]]
            stay = ~done
            stay[hit + 1] = False
            new_at = (np.cumsum(stay) - 1)[hit]
            symbols, place, fragment, rank = symbols[stay], place[stay], fragment[stay], rank[stay]
            mark = np.zeros(len(symbols) + 1, bool)
            mark[new_at] = mark[new_at - 1] = True  # at 0, the one before is the spare last
            changed = np.flatnonzero(mark[:-1])
            pairs = changed[changed + 1 < len(symbols)]
            pairs = pairs[fragment[pairs] == fragment[pairs + 1]]
            rank[changed] = NONE
            rank[pairs] = self._rank(symbols[pairs], symbols[pairs + 1])
        return out

    def _spelled(self, chunk: str) -> str:
        """Words of any chunk, split by the library, as text of one character for each byte."""
        words = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(chunk))
        return " ".join(bytes(self.byte_of[c] for c in w).decode("utf-8", "surrogateescape") for w, _ in words)

    def _encode_words(self, text) -> tuple:
        """Ids of words that each end in a space, and where each word's ids start."""
        kept = np.flatnonzero(text != 32)
        ends = text[kept + 1] == 32
        raw = text[kept] + 256 * ends.astype(np.int64)
        cut = np.concatenate([[True], ends[:-1] | ~self.inside[raw[:-1] & 255, raw[1:]]])
        ids = self._merge(self.first_ids[raw], cut)
        own = ids >= 0
        stop = np.cumsum(own)[ends]
        return ids[own], np.concatenate([[0], stop])

    def _encode_chunks(self, joined: str) -> tuple:
        """The ids of chunks that each end in a line feed, in one array, and where each chunk's ids start in it."""
        if self.plain.fullmatch(joined):
            words = " ".join(self.words.findall(joined.lower()))
        else:
            words = " ".join(
                (" ".join(self.words.findall(c.lower())) if self.plain.fullmatch(c) else self._spelled(c)) + " \n"
                for c in joined.split("\n")[:-1]
            )
        text = np.frombuffer((words + " ").encode("utf-8", "surrogateescape"), np.uint8)
        start, end = ranges(text != 32)
        line = text[start] == 10
        start, end = start[~line], end[~line]
        first, word = distinct(text, start, end)
        each, _ = gathered(text, start[first], end[first] + 1)
        ids, at = self._encode_words(each)
        flat, size = gathered(ids, at[word], at[word + 1])
        edge = np.concatenate([[0], np.cumsum(size)])
        return flat, edge[np.concatenate([[0], np.cumsum(~line)[line]])]

    def encode(self, texts: list) -> list[bytes]:
        """The ids of each text, as little-endian unsigned 32-bit integers."""
        parts: list[bytes] = []
        ends: list[int] = []
        todo: list[tuple[int, bytes]] = []
        size = 0
        for text in texts:
            for part in self.specials.split(text or ""):
                parts.append(self.special_ids.get(part, b""))
                if part and part not in self.special_ids:
                    todo.append((len(parts) - 1, part.encode()))
                    size += len(todo[-1][1])
            ends.append(len(parts))
            if size > TOGETHER:
                self._encode_together(todo, parts)
                todo, size = [], 0
        self._encode_together(todo, parts)
        return [b"".join(parts[a:b]) for a, b in zip([0, *ends], ends)]

    def _encode_together(self, todo: list[tuple[int, bytes]], out: list[bytes]) -> None:
        """Every distinct chunk between white space once, then the chunks' ids in the order of the texts."""
        text = np.frombuffer(b"".join(t + b"\n" for _, t in todo), np.uint8)
        start, end = ranges(~self.space[text])
        if not len(start):
            return
        first, chunk = distinct(text, start, end)
        each, size = gathered(text, start[first], end[first] + 1)
        each[np.cumsum(size) - 1] = 10
        ids, at = self._encode_chunks(each.tobytes().decode())
        flat, size = gathered(ids.astype("<u4"), at[chunk], at[chunk + 1])
        text_end = np.cumsum([len(t) + 1 for _, t in todo])
        stop = np.concatenate([[0], np.cumsum(size)])[np.searchsorted(start, text_end)].tolist()
        for (i, _), a, b in zip(todo, [0, *stop], stop):
            out[i] = flat[a:b].tobytes()

    def decode(self, ids: bytes | None) -> str:
        return " ".join(map(self.tokens.__getitem__, np.frombuffer(ids or b"", "<u4").tolist()))


def sliced(batches: Iterator[pd.Series]) -> Iterator[list]:
    for batch in batches:
        for at in range(0, len(batch), RETURNED):
            yield batch.iloc[at : at + RETURNED].tolist()


def codec(spec: str) -> Codec:
    """One codec for each tokenizer and worker process; it outlives the tasks of a reused worker."""
    held = worker_state("codecs")
    if spec not in held:
        held[spec] = Codec(spec)
    return held[spec]


class Tokenizer:
    """Column functions for one tokenizer file; its text goes to the executors as a broadcast of the file's size."""

    def __init__(self, spark: SparkSession, path: str):
        with open(path, encoding="utf-8") as file:
            spec = spark.sparkContext.broadcast(file.read())

        def encode_all(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            own = codec(spec.value)
            for texts in sliced(batches):
                yield pd.Series(own.encode(texts), dtype=object)

        def decode_all(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            own = codec(spec.value)
            for ids in sliced(batches):
                yield pd.Series([own.decode(x) for x in ids], dtype=object)

        def both_all(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            own = codec(spec.value)
            for texts in sliced(batches):
                ids = own.encode(texts)
                yield pd.DataFrame({"ids": ids, "decoded": [own.decode(x) for x in ids]})

        self._encode = F.pandas_udf(encode_all, "binary")
        self._decode = F.pandas_udf(decode_all, "string")
        self._both = F.pandas_udf(both_all, "ids binary, decoded string")

    def encode(self, text: str | Column) -> Column:
        """Ids as little-endian unsigned 32-bit integers, four bytes each."""
        return self._encode(text)

    def decode(self, ids: str | Column) -> Column:
        """Tokens joined by a space, special tokens included, as the library does without a decoder."""
        return self._decode(ids)


    def round_trip(self, text: str | Column) -> Column:
        """A struct of the ids and the text decoded from them, in one pass."""
        return self._both(text)
