"""Exact top-k against SQL and against all pairs."""

import math
import random
from collections import Counter

import duckdb
from pyspark.sql import functions as F

from lapsewise.llm import topk
from lapsewise.llm.queries import QUERIES, SQL
from oracle import compare, connect

NAME = "op4_segment_bounds_top_k"


def test_equals_sql(spark, sf_dir):
    assert compare(QUERIES[NAME](spark, sf_dir), connect(sf_dir), SQL[NAME]) == []


def wanted(rows, k):
    good = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n, (q, own) in enumerate(good):
        if q is None or q % 50:
            continue
        others = [(i, v) for m, (i, v) in enumerate(good) if m != n and len(v) == len(own)]
        scored = sorted((-sum(a * b for a, b in zip(own, v)), i is None, i or 0) for i, v in others)
        out += [(q, rank, None if late else i, -s) for rank, (s, late, i) in enumerate(scored[:k], 1)]
    return Counter(out)


def test_odd_vectors(spark, monkeypatch):
    """Nulls, non-finite components, ties, several lengths, more than one block of queries."""
    monkeypatch.setattr(topk, "BLOCK_NUMBERS", 20)
    monkeypatch.setattr(topk, "PAIRS", 1)
    rng = random.Random(2)
    rows = [(i, [rng.choice([-0.5, 0.0, 0.25, 1.0]) for _ in range(8)]) for i in range(200)]
    rows += [(200, None), (201, [None] * 8), (250, [float("nan")] * 8), (300, [float("inf")] * 8), (350, [1.0, 2.0]), (351, [0.5, -1.0]), (400, [])]
    table = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, q string")
    found = topk.search(table, F.col("vec_id") % 50 == 0).collect()
    assert Counter(tuple(r) for r in found) == wanted(rows, 5)


def test_repeated_ids(spark):
    """Query rows with one id and other vectors, equal query rows, and many rows without an id."""
    rng = random.Random(4)
    draw = lambda: [rng.choice([-0.5, 0.25, 1.0]) for _ in range(6)]
    rows = [(50, draw()) for _ in range(4)] + [(100, [1.0] * 6)] * 3 + [(None, draw()) for _ in range(20)] + [(7, draw()) for _ in range(5)]
    found = topk.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 50 == 0).collect()
    assert Counter(tuple(r) for r in found) == wanted(rows, 5) and len(found) == 7 * 5


def test_sql_tells_rows_apart(spark, tmp_path):
    rows = [(0, [1.0, 0.5]), (0, [0.25, 2.0]), (1, [1.0, 1.0]), (50, [0.5, 0.5]), (50, [0.5, 0.5]), (2, [3.0, 0.0])]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{tmp_path}/embeddings.parquet/*.parquet')")
    assert Counter(con.execute(f"SELECT query_id, rank, vec_id, score FROM ({SQL[NAME]})").fetchall()) == wanted(rows, 5)


def test_few_candidates_and_none(spark):
    table = spark.createDataFrame([(0, [1.0]), (1, [1.0]), (None, [1.0])], "vec_id long, embedding array<double>")
    found = topk.search(table, F.col("vec_id") % 50 == 0).collect()
    assert [tuple(r) for r in sorted(found, key=lambda r: r.rank)] == [(0, 1, 1, 65536), (0, 2, None, 65536)]
    assert topk.search(table.limit(0), F.col("vec_id") % 50 == 0).collect() == []
