"""Quality scores: held-out accuracy, voting against a plain version, odd input."""

import zlib

import numpy as np
import pytest

from lapsewise.llm import knn_quality as Q
from lapsewise.llm.queries import QUERIES


def test_query(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = {r.doc_id: r for r in QUERIES["op5_knn_quality"](spark, sf_dir).collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    for r in rows.values():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
    held = [(rows[i].score, q) for i, q in labels.items() if rows[i].held_out]
    good, bad = ([s for s, q in held if q == k] for k in (1, 0))
    assert len(bad) > 5
    assert np.mean([g > b for g in good for b in bad]) > 0.95
    assert np.mean([s >= 0.3 for s in good]) > 0.97


def test_votes_equal_a_plain_loop():
    rng = np.random.default_rng(1)
    words = [f"w{i}" for i in range(50)]
    texts = [" ".join(rng.choice(words, rng.integers(1, 30))) for _ in range(60)]
    label = rng.integers(0, 2, 60)
    counts = np.sqrt(Q.term_counts(texts))
    model = Q.fitted(counts, label)
    got = Q.voted(np.sqrt(Q.term_counts(texts[:10] + [""])), model)
    assert got[-1] == pytest.approx(label.mean())
    for i in range(10):
        own = Q.weighted(counts[i : i + 1], model["idf"]) @ model["basis"]
        own = own[0] / np.linalg.norm(own)
        near = sorted(range(60), key=lambda j: -(own @ model["vectors"][j]))[: Q.NEIGHBOURS]
        weight = [max(own @ model["vectors"][j], 0) ** 4 for j in near]
        score = (sum(w * label[j] for w, j in zip(weight, near)) + Q.PRIOR_WEIGHT * label.mean()) / (sum(weight) + Q.PRIOR_WEIGHT)
        assert got[i] == pytest.approx(score, rel=1e-3)


def test_counts_are_of_the_whole_text():
    counts = Q.term_counts(["A a b 12 &&&", None, "b " * 400_000])
    assert counts[0, : Q.WORD_TERMS].sum() == 5 and counts[1].sum() == 0 and counts[2, : Q.WORD_TERMS].sum() == 400_000


def test_odd_documents(spark, odd_documents, no_documents):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(9)] + [(None, 1, 0), (3, None, 0), (5, 1, 0)], "doc_id long, quality int, toxic int")
    model = Q.fit(odd_documents, labels)
    rows = odd_documents.select("doc_id", Q.held_out().alias("held_out"), Q.score(odd_documents, model).alias("score")).collect()
    assert len(rows) == odd_documents.count() and all(0 <= r.score <= 1 for r in rows)
    assert not any(r.held_out for r in rows if r.doc_id is None)
    none = Q.fit(odd_documents, labels.limit(0))
    assert none is None and {r[0] for r in odd_documents.select(Q.score(odd_documents, none)).collect()} == {0.5}
    assert Q.fit(no_documents, labels) is None
    assert no_documents.select(Q.score(no_documents, model)).collect() == []


def test_sample_is_of_documents(spark):
    """Repeated rows and labels of a document take one place, labels without a document none."""
    docs = spark.createDataFrame([(1, f"text {i}") for i in range(300)] + [(i, f"word {i}") for i in range(2, 40)], "doc_id long, text string")
    labels = [(1, 1)] * 50 + [(1, 0)] + [(i, 1) for i in range(2, 40)] + [(i, 0) for i in range(1000, 1100)]
    table = spark.createDataFrame(labels, "doc_id long, quality int")
    usable = [i for i in range(1, 40) if zlib.crc32(str(i).encode()) % 5]
    model = Q.fit(docs, table, sample=500)
    assert len(model["label"]) == len(usable) and model["label"].sum() == len(usable) - (1 in usable)
    assert len(Q.fit(docs, table, sample=10)["label"]) == 10
