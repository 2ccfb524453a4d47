"""Quality scores by nearest-neighbour voting over latent semantic vectors.

A text is counts of hashed words, hashed byte pairs and a few word shapes. On a bounded sample of
labelled texts (``SAMPLE`` rows, picked by a hash of doc_id) inverse document frequencies and a
truncated singular value decomposition are fitted; the sample's latent vectors and labels are
broadcast, which is SAMPLE * LATENT numbers whatever the corpus. Every text is then compared with
all of them by exact cosine, block by block, and its nearest neighbours vote, weighted by
similarity. Labels, language, source and doc_id are never inputs of a score.

Rows whose crc32 of doc_id, as text, is a multiple of 5 are held out of the fit. A null or empty
text has a zero vector and gets the share of label 1 in the sample. Ties between neighbours go to
the sample's order. A null doc_id is not held out and never in the sample. Repeated rows get equal
scores. Without any label all scores are 0.5; an empty table gives an empty one.
"""

import sys

import numpy as np
import pandas as pd
from collections.abc import Iterator
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapsewise.llm.arrays import ascii_space, hash_of, ranges

# executors unpickle the helpers below without having this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Labelled rows that the classifier is fitted on, at most.
SAMPLE = 4096
#: Columns for hashed words, hashed byte pairs and shapes; latent dimensions; neighbours that vote.
WORD_TERMS, PAIR_TERMS, SHAPES, LATENT, NEIGHBOURS = 512, 480, 32, 64, 25
TERMS = WORD_TERMS + PAIR_TERMS + SHAPES
#: Lengths of the three kinds of terms in a document's vector.
WEIGHTS = (0.5, 0.5, 1.0)
#: Similarity that the sample's share of label 1 counts with in each vote.
PRIOR_WEIGHT = 0.5
#: Bytes of texts handled at once, and texts scored at once.
TOGETHER, BLOCK = 1_000_000, 256


def term_counts(texts: list):
    """A row of term counts for each text."""
    raw = [(t or "").encode("utf-8", "surrogatepass").lower() for t in texts]
    text = np.frombuffer(b"".join(r + b"\n" for r in raw), np.uint8)
    size = np.array([len(r) + 1 for r in raw])
    owner = np.repeat(np.arange(len(raw)), size)
    space = ascii_space()[text]
    start, end = ranges(~space)
    out = np.zeros((len(raw), TERMS), np.float32)
    if not len(start):
        return out
    who = owner[start]
    word = hash_of(text, start, end, 0)

    def add(rows, terms, first, n):
        cells = np.bincount(rows * n + terms, minlength=len(raw) * n)
        out[:, first : first + n] += cells.reshape(len(raw), n)

    add(who, (word >> np.uint64(40)).astype(np.int64) % WORD_TERMS, 0, WORD_TERMS)
    shown = np.where(space, 32, text).astype(np.int64)
    pair = (shown[:-1] * 256 + shown[1:]) * 2654435761 >> 12
    inside = owner[:-1] == owner[1:]  # a score must not depend on the next text
    add(owner[:-1][inside], pair[inside] % PAIR_TERMS, WORD_TERMS, PAIR_TERMS)

    letter = ((text >= 97) & (text <= 122)) | (text >= 128)
    digit = (text >= 48) & (text <= 57)
    letters, digits, tail = (np.cumsum(np.r_[0, x]) for x in (letter, digit, ~(letter | digit | np.isin(text, list(b".,;:!?'\"()-")))))
    length = end - start
    n_letters, n_digits, n_odd = (x[end] - x[start] for x in (letters, digits, tail))
    again = np.zeros(len(word), bool)
    again[1:] = (word[1:] == word[:-1]) & (who[1:] == who[:-1])
    shape = np.minimum(length, 16) - 1
    first = WORD_TERMS + PAIR_TERMS
    add(who, shape, first, SHAPES)
    for k, mark in enumerate((again, n_letters == 0, n_digits * 2 > length, n_odd > 0, n_odd * 3 >= length)):
        add(who[mark], np.full(mark.sum(), 16 + k), first, SHAPES)
    return out


def weighted(roots, idf):
    """From square roots of counts: each kind of term as a direction of its own length, so that none drowns the others."""
    parts = np.split(roots * idf, [WORD_TERMS, WORD_TERMS + PAIR_TERMS], axis=1)
    return np.hstack([unit(part) * w for part, w in zip(parts, WEIGHTS)]).astype(np.float32)


def unit(rows):
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)


def fitted(roots, label) -> dict:
    """Inverse document frequencies, the latent basis, and the sample's latent vectors and labels."""
    idf = (np.log((1 + len(roots)) / (1 + (roots > 0).sum(0))) + 1).astype(np.float32)
    rows = weighted(roots, idf)
    _, basis = np.linalg.eigh(rows.T @ rows)
    basis = basis[:, ::-1][:, :LATENT].astype(np.float32)
    return {"idf": idf, "basis": basis, "vectors": unit(rows @ basis), "label": label.astype(np.float32)}


def voted(roots, model: dict):
    share = float(model["label"].mean())
    latent = unit(weighted(roots, model["idf"]) @ model["basis"])
    latent[roots.sum(1) == 0] = 0
    cosine = np.maximum(latent @ model["vectors"].T, 0)
    k = min(NEIGHBOURS, cosine.shape[1])
    near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
    weight = np.take_along_axis(cosine, near, 1) ** 4
    return ((weight * model["label"][near]).sum(1) + PRIOR_WEIGHT * share) / (weight.sum(1) + PRIOR_WEIGHT)


def blocks(texts: list):
    at, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text or "")
        if size > TOGETHER or i + 1 - at == BLOCK or i + 1 == len(texts):
            yield texts[at : i + 1]
            at, size = i + 1, 0


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> dict | None:
    """The classifier, from at most ``sample`` labelled documents, one row of each; None without any.

    A doc_id with several labels has the smallest of them, one with several texts the text of smallest hash.
    """
    known = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    # chosen among the labels that have a document, so that a label without one takes no place
    held = docs.select("doc_id").where(F.col("doc_id").isNotNull()).distinct()
    known = known.groupBy("doc_id").agg(F.min("quality").alias("quality")).join(held, "doc_id", "left_semi")
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    texts = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")
    one = F.min(F.struct(F.xxhash64("text").alias("h"), "text", "quality")).alias("one")
    texts = texts.groupBy("doc_id").agg(one).select("doc_id", "one.text", "one.quality")

    @F.pandas_udf("binary")
    def counted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            for part in blocks(batch.tolist()):
                # half precision holds the root of any count below 4 * 10 ** 9, and keeps what the driver gets small
                yield pd.Series([row.tobytes() for row in np.sqrt(term_counts(part)).astype(np.float16)], dtype=object)

    rows = sorted(texts.select("doc_id", "quality", counted("text").alias("roots")).collect(), key=lambda r: r["doc_id"])
    if not rows:
        return None
    roots = np.frombuffer(b"".join(r["roots"] for r in rows), np.float16).reshape(len(rows), TERMS)
    return fitted(roots.astype(np.float32), np.array([r["quality"] > 0 for r in rows]))


def score(docs: DataFrame, model: dict | None, text: str = "text") -> Column:
    """The score of a text, as a column of docs."""
    if model is None:
        return F.lit(0.5)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def vote(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            for part in blocks(batch.tolist()):
                yield pd.Series(voted(np.sqrt(term_counts(part)), sent.value).astype(float))

    return vote(text)
