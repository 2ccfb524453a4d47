"""Rendezvous hashing: SQL, the laws, weights, slots."""

import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from lapsewise.llm import sharding
from lapsewise.llm.queries import QUERIES, SQL
from oracle import compare, connect

NAME = "op2_rendezvous_shards"


def test_equals_sql(spark, sf_dir):
    assert compare(QUERIES[NAME](spark, sf_dir), connect(sf_dir), SQL[NAME]) == []


def test_one_more_shard_takes_rows_only_into_itself(spark):
    keys = spark.range(20000).withColumnRenamed("id", "doc_id").withColumn("text", F.lit("x"))
    rows = sharding.sharded(keys, 8).collect()
    moved = [r for r in rows if r.shard != r.grown_shard]
    assert all(r.grown_shard == 8 for r in moved) and 0.08 < len(moved) / len(rows) < 0.14
    assert max(Counter(r.shard for r in rows).values()) < 1.1 * 20000 / 8


def test_weights(spark):
    shard = sharding.shard_of(F.col("id"), [1.0, 3.0])
    counts = Counter(r.s for r in spark.range(20000).select(shard.alias("s")).collect())
    assert 0.73 < counts[1] / 20000 < 0.77


def test_odd_documents(spark, odd_documents, no_documents):
    rows = sharding.sharded(odd_documents, 4).collect()
    assert len(rows) == odd_documents.count()
    slots, shard = defaultdict(list), {}
    for r in rows:
        slots[r.shard].append(r.slot)
        assert shard.setdefault(r.doc_id, r.shard) == r.shard
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    texts = Counter((r.doc_id, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in odd_documents.collect())
    assert texts == Counter((r.doc_id, r["size"], r.text_crc32) for r in rows)
    assert sharding.sharded(no_documents).collect() == []
