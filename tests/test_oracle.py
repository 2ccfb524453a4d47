"""Every registered query with SQL equals DuckDB; the others return rows."""

import pytest
from oracle import compare, connect

import __spark_entry__ as entry

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, sf_dir, duck, name):
    assert compare(QUERIES[name](spark, sf_dir), duck, ORACLES[name]) == []


# queries that fit models are covered at sf0.001 by test_models.py and friends
@pytest.mark.parametrize(
    "name", ["pca_scatter", "kmeans_segment_profile", "score_records"]
)
def test_returns_rows(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
