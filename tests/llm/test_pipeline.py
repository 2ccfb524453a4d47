"""Each stage on the rows that the one before kept, against the operators' plain versions."""

import brute
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from lapsewise.sources.workspace import materialise


@pytest.fixture(scope="module")
def outputs(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = {"documents": docs}
    for name, stage in P.STAGES:
        docs = out[name] = materialise(stage(spark, docs, sf_dir), name)
    return {name: (df.columns, [r.asDict() for r in df.collect()]) for name, df in out.items()}


def texts(outputs, name):
    return {r["doc_id"]: r["text"] for r in outputs[name][1]}


def test_columns_stay(outputs):
    columns = outputs["documents"][0]
    for name, _ in P.STAGES[:-1]:
        assert outputs[name][0] == columns


def test_rules(outputs):
    before, after = texts(outputs, "documents"), texts(outputs, "quality_rules")
    numbers = {i: brute.rule_numbers(t) for i, t in before.items()}
    failed = {i for i, n in numbers.items() if n[0] < 50 or 100 * n[4] > 50 * n[0]}
    assert not failed & set(after) and len(after) > 0.8 * (len(before) - len(failed))
    assert all(before[i] == t for i, t in after.items())


def test_classifier_keeps_clean_documents(spark, sf_dir, outputs):
    before, after = texts(outputs, "quality_rules"), texts(outputs, "quality_classifier")
    good = {r.doc_id for r in spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality = 1").collect()}
    assert set(after) <= set(before) and len(good & set(before) - set(after)) <= 0.03 * len(good)


def test_lines(outputs):
    before = list(texts(outputs, "quality_classifier").items())
    assert texts(outputs, "line_dedup") == {i: t for i, (t, _) in brute.without_repeats(before).items()}
    assert all(r["n_chars"] == len(r["text"]) for r in outputs["line_dedup"][1])


def test_near_duplicates(outputs):
    before = list(texts(outputs, "line_dedup").items())
    component = brute.near_components(before, P.NEAR_WORDS)
    assert set(texts(outputs, "near_dedup")) == {i for i, _ in before if component[i] == i}


def test_packing(outputs):
    pieces = outputs["packing"][1]
    assert {p["doc_id"] for p in pieces} == set(texts(outputs, "near_dedup"))
    assert all(0 <= p["offset"] and p["offset"] + p["length"] <= 4096 for p in pieces)


def test_run(spark, sf_dir, outputs):
    assert P.run(spark, sf_dir).count() == len(outputs["packing"][1])


def test_odd_documents(spark, sf_dir, odd_documents):
    clean = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" + "." * (i % 12 == 11) for i in range(120))
    extra = [(None, clean, 1, "x"), (20, clean, 1, "x"), (20, clean, 1, "x"), (21, clean + " end", 2, "y")]
    docs = odd_documents.union(spark.createDataFrame(extra, odd_documents.schema)).withColumn("row", F.lit(1)).withColumn("_rules", F.lit(2))
    for name, stage in P.STAGES[:-1]:
        alone, empty = stage(spark, docs, sf_dir), stage(spark, docs.limit(0), sf_dir)
        assert alone.columns == empty.columns == docs.columns and empty.count() == 0
        kept = alone.collect()
        assert {r.doc_id for r in kept} >= {None, 20}, name
        if name == "near_dedup":
            assert sum(r.doc_id == 20 for r in kept) == 1 and not any(r.doc_id == 21 for r in kept)
    assert {r.doc_id for r in P.packed(spark, docs, sf_dir).collect()} == {r.doc_id for r in docs.collect()}


def test_rows_are_linked_by_their_texts(spark, sf_dir):
    """Rows of one doc_id with different texts stay; copies without doc_id go with the others."""
    one, two, three = (" ".join(f"{k}word{i}" for i in range(60)) for k in "abc")
    rows = [(1, one), (1, two), (None, three), (None, three), (2, three), (None, one), (3, None), (3, None), (4, ""), (1, one)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = sorted((tuple(r) for r in P.near_duplicates(spark, docs, sf_dir).collect()), key=str)
    assert kept == sorted([(1, one), (1, two), (2, three), (3, None), (3, None), (4, "")], key=str)
