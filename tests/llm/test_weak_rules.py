"""Base numbers and estimated accuracies against plain versions."""

import math

import brute
import pytest
from pyspark.sql import functions as F

from lapsewise.llm import weak_rules as R
from lapsewise.llm.queries import QUERIES

NAME = "op7_weak_quality_rules"


def test_query(spark, sf_dir, documents):
    rows = {r.doc_id: r for r in QUERIES[NAME](spark, sf_dir).collect()}
    assert len(rows) == len(documents)
    for doc_id, text in documents:
        r, n = rows[doc_id], brute.rule_numbers(text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == n
        assert r.base_failed == (n[0] < 50 or 100 * n[4] > 50 * n[0])
        assert r.kept == (not r.base_failed and r.posterior >= 0.5)


def test_clean_documents_stay_and_bad_ones_go(spark, sf_dir):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    rows = [r for r in QUERIES[NAME](spark, sf_dir).collect() if r.doc_id in labels and not r.base_failed]
    right = sum(r.kept == (labels[r.doc_id] == 1) for r in rows)
    assert right >= 0.95 * len(rows)


def test_estimates_equal_a_plain_loop(spark):
    patterns = [(1, 1, 0, 700), (1, -1, 0, 40), (-1, -1, -1, 150), (-1, 1, 0, 30), (0, 1, -1, 20)]
    share, weights = R.fit(spark.createDataFrame(patterns, "a int, b int, c int, count long"))
    own, odds = 0.5, {r: (math.log(R.WRONG / R.RIGHT), math.log(R.RIGHT / R.WRONG)) for r in "abc"}
    for _ in range(R.ROUNDS):
        def chance(row):
            z = math.log(own / (1 - own)) + sum({1: odds[r][1], -1: odds[r][0], 0: 0.0}[v] for r, v in zip("abc", row))
            return 1 / (1 + math.exp(-z))

        mass = [(row, chance(row) * row[3], (1 - chance(row)) * row[3]) for row in patterns]
        good, bad = (sum(m[k] for m in mass) for k in (1, 2))

        def odd(i, v):
            up, down = (sum(m[k] for m in mass if m[0][i] == v) for k in (1, 2))
            plus, minus = (R.RIGHT, R.WRONG) if v == 1 else (R.WRONG, R.RIGHT)
            total = R.RIGHT + R.NONE + R.WRONG
            return math.log(((up + plus) / (good + total)) / ((down + minus) / (bad + total)))

        odds = {r: (min(odd(i, -1), 0.0), max(odd(i, 1), 0.0)) for i, r in enumerate("abc")}
        own = min(max((good + R.RIGHT) / (good + bad + 2 * R.RIGHT), 0.05), 0.95)
    assert share == pytest.approx(own) and all(weights[r] == pytest.approx(odds[r]) for r in "abc")


def test_windows_with_equal_hashes(spark, monkeypatch):
    """With a hash that is equal for all windows, the words themselves decide."""
    monkeypatch.setattr(R.F, "xxhash64", lambda *columns: F.lit(0).cast("long"))
    texts = ["a b c a b c x y z", "p q r s t u", "k k k k", ""]
    rows = R.measured(spark.createDataFrame([(t,) for t in texts], "text string"))
    assert [r._rules.n_repeat_words for r in rows.collect()] == [brute.rule_numbers(t)[4] for t in texts]


def test_odd_documents(spark, odd_documents, no_documents):
    judged = R.judged(odd_documents)
    assert judged.columns == [*odd_documents.columns, "_rules"]
    rows = judged.collect()
    assert len(rows) == odd_documents.count()
    for r in rows:
        n = brute.rule_numbers(r.text)
        assert (r._rules.n_words, r._rules.word_chars, r._rules.n_symbols, r._rules.n_dup_lines, r._rules.n_repeat_words) == n
        assert r._rules.base_failed and not r._rules.kept
    assert R.judged(no_documents).collect() == []
