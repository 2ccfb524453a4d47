"""Fill-in-middle transformation by content-defined chunks.

A rolling hash over the UTF-8 bytes cuts a text into chunks wherever the last WINDOW bytes say so,
so passages that documents share fall into equal chunks. A chunk's summary is what its parents need
to know of it: its code points, whether it holds a sentinel, and the bytes at its two ends, in which a
sentinel over a border shows. Summaries are kept by the chunk's whole content in a worker's cache
of bounded size; a shared chunk is looked at once. Counts of code points add up over the chunks, which
gives a document's length, and the chunk that a cut falls into; only that chunk's bytes are counted.

The cuts and the form come from a digest of the document's key. A text that is empty or that holds a
sentinel stays plain, as does a share of the others. A null text counts as empty, a null key as the word
null. Rows are never dropped or merged: repeated rows come out alike, extra columns are ignored, an
empty table gives an empty one. A text is held whole by the task that reads its row; a chunk has
at most LONGEST bytes.
"""

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapsewise.llm.arrays import hash_of, worker_state

# executors unpickle the helpers below without having this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Bytes that the rolling hash sees; also the least size of a chunk that is not its text's last.
WINDOW = 32
#: A cut where that many low bits of the hash are zero: chunks of about 1 KB.
BITS = 10
#: A chunk ends here at the latest, or up to three bytes earlier, before a code point.
LONGEST = 16384
#: Bytes of chunks whose summaries a worker keeps; then it starts anew.
CACHED = 64_000_000
#: Bytes hashed together.
TOGETHER = 1 << 20


def cut_marks(data: bytes) -> np.ndarray:
    """Places after which the rolling hash cuts, from the WINDOW-th byte on."""
    found = []
    text = np.frombuffer(data, np.uint8)
    for at in range(0, len(text), TOGETHER):
        part = text[max(0, at - WINDOW + 1) : at + TOGETHER]
        end = np.arange(WINDOW, len(part) + 1)
        if len(end):
            value = hash_of(part, end - WINDOW, end, 0) >> np.uint64(20)
            found.append(end[value & np.uint64((1 << BITS) - 1) == 0] + max(0, at - WINDOW + 1))
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def bounds(data: bytes, marks) -> list[int]:
    """Ends of the chunks of one text; each one stands before the first byte of a code point."""
    out, last = [], 0

    def close(end: int) -> None:
        nonlocal last
        while end - last > LONGEST:
            stop = last + LONGEST
            while data[stop] & 0xC0 == 0x80:
                stop -= 1
            out.append(stop)
            last = stop
        if end > last:
            out.append(end)
            last = end

    for mark in marks:
        if mark - last >= WINDOW and mark < len(data) and data[mark] & 0xC0 != 0x80:
            close(mark)
    close(len(data))
    return out


class Summaries:
    """code points, holds a sentinel, first and last two bytes, by content."""

    def __init__(self):
        self.sentinels = [s.encode() for s in (PREFIX, SUFFIX, MIDDLE)]
        self.held: dict[bytes, tuple] = {}
        self.size = 0

    def of(self, chunk: bytes) -> tuple:
        found = self.held.get(chunk)  # compares the whole content
        if found is None:
            points = len(chunk) if chunk.isascii() else len(chunk.decode("utf-8", "surrogatepass"))
            found = points, any(s in chunk for s in self.sentinels), chunk[:2], chunk[-2:]
            if self.size + len(chunk) > CACHED:
                self.held.clear()
                self.size = 0
            self.held[chunk] = found
            self.size += len(chunk)
        return found

    def joined(self, a: tuple, b: tuple) -> tuple:
        """The summary of a chunk followed by another; associative."""
        border = a[3] + b[2]
        return (
            a[0] + b[0],
            a[1] or b[1] or any(s in border for s in self.sentinels),
            (a[2] + b[2])[:2] if len(a[2]) < 2 else a[2],
            (a[3] + b[3])[-2:] if len(b[3]) < 2 else b[3],
        )


class Chunked:
    """A text as chunks; finds its length and the bytes of code points through their summaries."""

    def __init__(self, data: bytes, marks, summaries: Summaries):
        self.ends = bounds(data, marks)
        self.data, self.points = data, [0]
        total = (0, False, b"", b"")
        for start, end in zip([0, *self.ends], self.ends):
            total = summaries.joined(total, summaries.of(data[start:end]))
            self.points.append(total[0])
        self.length, self.has_sentinel = total[0], total[1]

    def byte_of(self, point: int) -> int:
        """The byte before which ``point`` code points stand."""
        which = int(np.searchsorted(self.points, point, "right")) - 1
        left = point - self.points[which]
        if not left:
            return self.ends[which - 1] if which else 0
        start, end = (self.ends[which - 1] if which else 0), self.ends[which]
        if end - start == self.points[which + 1] - self.points[which]:
            return start + left
        chunk = np.frombuffer(self.data, np.uint8, end - start, start)
        return start + int(np.flatnonzero((chunk & 0xC0) != 0x80)[left])


def transformed_text(text: Chunked, h1: int, h2: int, h3: int, h4: int, plain_from: int, spm_below: int) -> tuple:
    """n, form, prefix_chars, middle_chars, output."""
    n = text.length
    first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not n or text.has_sentinel or h3 % 100 >= plain_from:
        return n, "plain", None, None, text.data.decode("utf-8", "surrogatepass")
    a, b = text.byte_of(first), text.byte_of(second)
    prefix, middle, suffix = (x.decode("utf-8", "surrogatepass") for x in (text.data[:a], text.data[a:b], text.data[b:]))
    if h4 % 100 < spm_below:
        return n, "spm", first, second - first, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return n, "psm", first, second - first, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def groups(texts: list[bytes]) -> Iterator[tuple[list[bytes], list]]:
    """Texts of about TOGETHER bytes with the cut marks of each; the hash is computed for all of them at once."""
    at = 0
    while at < len(texts):
        stop, size = at, 0
        while stop < len(texts) and (stop == at or size + len(texts[stop]) <= TOGETHER):
            size += len(texts[stop])
            stop += 1
        marks = cut_marks(b"".join(texts[at:stop]))
        start = np.cumsum([0, *map(len, texts[at:stop])])
        # the first bytes of a text have others before them in the window: no cuts there
        low, high = np.searchsorted(marks, start[:-1] + WINDOW), np.searchsorted(marks, start[1:], "right")
        yield texts[at:stop], [(marks[a:b] - s).tolist() for a, b, s in zip(low, high, start)]
        at = stop


def digests(key: str | Column) -> list[Column]:
    """Four numbers below 2**32 from the SHA-256 of ``1:`` and the key."""
    key = F.col(key) if isinstance(key, str) else key
    hexed = F.sha2(F.concat(F.lit("1:"), F.coalesce(key.cast("string"), F.lit("null"))), 256)
    return [F.conv(F.substring(hexed, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def transformed(docs: DataFrame, key: str = "doc_id", text: str = "text", plain_from: int = 90, spm_below: int = 20) -> DataFrame:
    """key, n, form, prefix_chars, middle_chars and output; ``plain_from`` and ``spm_below`` are of 100."""

    def run(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        held = worker_state("chunks")
        summaries = held.setdefault("summaries", Summaries())
        for texts, *hashes in batches:
            rows, at = [], 0
            numbers = list(zip(*(h.tolist() for h in hashes)))
            for together, marks in groups([(t or "").encode("utf-8", "surrogatepass") for t in texts]):
                for data, own in zip(together, marks):
                    rows.append(transformed_text(Chunked(data, own, summaries), *numbers[at], plain_from, spm_below))
                    at += 1
            out = pd.DataFrame(rows, columns=["n", "form", "prefix_chars", "middle_chars", "output"])
            yield out.astype({"n": "int64", "prefix_chars": "Int64", "middle_chars": "Int64"})

    made = F.pandas_udf(run, "n long, form string, prefix_chars long, middle_chars long, output string")
    rows = docs.select(F.col(f"`{key}`").alias("_key"), made(F.col(f"`{text}`"), *digests(f"`{key}`")).alias("_made"))
    return rows.select(F.col("_key").alias(key), "_made.*")


def restored(output: str | Column, form: str | Column) -> Column:
    """The text that an output was made from. A text in a cut form holds no sentinel, so the first and last ones are the form's own."""
    output, form = (F.col(c) if isinstance(c, str) else c for c in (output, form))
    middle = F.substring_index(output, MIDDLE, -1)
    head = F.substring(output, len(PREFIX) + 1, 2**31 - 1)
    before = F.substring_index(output, MIDDLE, 1)
    psm = F.concat(F.substring_index(head, SUFFIX, 1), middle, F.substring_index(before, SUFFIX, -1))
    spm = F.concat(F.substring_index(before, PREFIX, -1), middle, F.substring_index(head, PREFIX, 1))
    return F.when(form == "plain", output).when(form == "psm", psm).otherwise(spm)
