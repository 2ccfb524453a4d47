"""Three-line windows against SQL and a plain loop."""

import brute

from lapsewise.llm import line_dedup
from lapsewise.llm.queries import QUERIES, SQL
from oracle import compare, connect

NAME = "op6_line_windows"


def test_equals_sql(spark, sf_dir):
    assert compare(QUERIES[NAME](spark, sf_dir), connect(sf_dir), SQL[NAME]) == []


def test_equals_a_plain_loop(spark, sf_dir, documents):
    got = {r.doc_id: (r.text, r.n_removed) for r in QUERIES[NAME](spark, sf_dir).collect()}
    assert got == brute.without_repeats(documents)
    assert any(n for _, n in got.values())


def test_overlaps_blank_lines_and_repeats_in_one_text(spark):
    rows = [(1, "a\nb\nc\nd\ne"), (2, "x\n b\n\nc \nd\ne\ny"), (3, "k\nk\nk\nk\nk"), (4, "a\nb"), (5, "a\nb\nc\nd\ne")]
    got = {r.doc_id: (r.text, r.n_removed) for r in line_dedup.without_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute.without_repeats(rows)
    assert got[2] == ("x\ny", 5) and got[3] == ("k", 4) and got[4] == ("a\nb", 0) and got[5] == ("", 5)


def test_odd_documents(spark, odd_documents, no_documents):
    got = line_dedup.without_repeats(odd_documents)
    assert got.columns == [*odd_documents.columns, "n_removed"]
    rows = got.collect()
    assert len(rows) == odd_documents.count()
    texts = {r.doc_id: (r.text, r.n_removed) for r in rows if r.doc_id is not None}
    assert texts[1] == ("", 0) and texts[2] == (None, 0) and texts[7] == ("one\n\ntwo\n three\nfour", 0) and texts[8] == ("four", 4)
    assert line_dedup.without_repeats(no_documents).collect() == []


def test_hot_window_is_split(spark):
    """One window in nine of ten texts, over many parts, and the same rows as in one."""
    rows = [(i, "p\nq\nr" if i % 10 else f"p\nq\nr\n{i}") for i in range(400)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.text, r.n_removed) for r in line_dedup.without_repeats(table, hot_rows=7).collect()}
    assert got == brute.without_repeats(rows)


def test_column_of_the_count_s_name(spark):
    table = spark.createDataFrame([(1, "a\nb\nc", 9), (2, "a\nb\nc", 9)], "doc_id long, text string, N_removed int")
    got = line_dedup.without_repeats(table)
    assert got.columns == ["doc_id", "text", "n_removed"]
    assert sorted(tuple(r) for r in got.collect()) == [(1, "a\nb\nc", 0), (2, "", 3)]
    assert line_dedup.without_repeats(table, removed="gone").columns == ["doc_id", "text", "N_removed", "gone"]
