"""Sharding by weighted rendezvous hashing, in DataFrame functions only.

Every record key and shard give a pseudo-random number; the shard with the smallest one, after
its weight is applied, gets the record. A further shard competes with unchanged numbers, so it
only takes records away for itself, in proportion to its weight. The key and the shards decide
alone: rows with one key share a shard, whatever their number, and a null key is a key of its own.

Inside a shard, rows are numbered without gaps in the order of key, text and size; equal rows are
interchangeable. The numbering sorts by ranges over all shards, so a large shard or key is spread
over many tasks. Null texts have no bytes; an empty table gives an empty one.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from lapsewise.sources.workspace import materialise


def number(key: Column, shard: int, weight: float = 1.0) -> Column:
    """An exponential variate for a key and a shard: the smallest of several wins by weight."""
    digest = F.md5(F.concat(F.coalesce(key.cast("string"), F.lit("null")), F.lit(f":{shard}")).cast("binary"))
    uniform = (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / 2.0**52
    return -F.ln(uniform) / weight


def shard_of(key: Column, weights: list[float]) -> Column:
    """The number of the key's shard. Ties, of chance 1 in 2**52, go to the smaller shard."""
    return F.array_min(F.array(*(F.struct(number(key, s, w).alias("n"), F.lit(s).alias("s")) for s, w in enumerate(weights))))["s"]


def numbered(rows: DataFrame, shard: str, order: list[str]) -> DataFrame:
    """Adds slot: the row's place in its shard, from 0, in the given order."""
    keys = [shard, *order, "_row"]
    stored = rows.withColumn("_row", F.monotonically_increasing_id())
    # written, so that a lost task is never numbered anew; _row only tells equal rows apart
    stored = materialise(stored, "shards")
    placed = stored.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_place", F.monotonically_increasing_id())
    placed = materialise(placed.drop("_row"), "placed").withColumn("_part", F.shiftright("_place", 33))
    runs = placed.groupBy(shard, "_part").agg(F.min("_place").alias("_low"), F.count("*").alias("_n"))
    before = W.partitionBy(shard).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    runs = runs.select(shard, "_part", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_low")).alias("_shift"))
    return placed.join(runs, [shard, "_part"]).withColumn("slot", F.col("_place") + F.col("_shift")).drop("_place", "_part", "_shift")


def sharded(docs: DataFrame, shards: int = 16, weights: list[float] | None = None, text: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, and the shard that one more shard of weight 1 would leave."""
    weights = weights or [1.0] * shards
    full, key = F.coalesce(F.col(text), F.lit("")), F.col("doc_id")
    rows = docs.select(
        "doc_id",
        (F.octet_length(full) + 1).cast("long").alias("size"),
        F.crc32(full.cast("binary")).alias("text_crc32"),
        shard_of(key, weights).alias("shard"),
        shard_of(key, [*weights, 1.0]).alias("grown_shard"),
    )
    rows = numbered(rows, "shard", ["doc_id", "text_crc32", "size"])
    return rows.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")
