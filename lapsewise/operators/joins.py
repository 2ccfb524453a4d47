"""Joins that keep working when one key holds a large share of the rows."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A key with more matching rows than this is split over several tasks.
HOT_ROWS = 5_000_000
NULL_SPREAD = 64


def join_lookup(
    big: DataFrame,
    lookup: DataFrame,
    on: list[str],
    weight: str,
    spread: list[str],
    how: str = "left",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Join ``big`` to a lookup that has one row per key.

    ``weight`` is the lookup column with the number of rows of ``big`` that carry the key; it is
    dropped. A hot key is split into weight / hot_rows parts: its lookup row is repeated once per
    part and its rows in ``big`` are spread over the parts by a hash of ``spread``. Rows with a null
    key never match and are spread as well. There is one plan; whether a side is small enough to be
    broadcast is left to Spark, which knows its size when the join runs.
    """
    parts = F.ceil(F.col(weight) / F.lit(float(hot_rows))).cast("bigint")
    hot = lookup.where(F.col(weight) > hot_rows).select(*on, parts.alias("_parts"))
    row_hash = F.xxhash64(*spread)
    any_null = F.lit(False)
    for key in on:
        any_null = any_null | F.col(key).isNull()
    salted = big.join(hot, on, "left").withColumn(
        "_salt",
        F.when(any_null, F.pmod(row_hash, F.lit(NULL_SPREAD)))
        .otherwise(F.coalesce(F.pmod(row_hash, F.col("_parts")), F.lit(0)))
        .cast("bigint"),
    ).drop("_parts")
    repeated = lookup.withColumn(
        "_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.greatest(parts, F.lit(1)) - 1))
    ).drop(weight)
    return salted.join(repeated, [*on, "_salt"], how).drop("_salt")


def with_overall(df: DataFrame, stats: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Attach one-row statistics as scalar subqueries: {new column: statistics column}."""
    return df.select(
        "*", *[stats.select(source).scalar().alias(name) for name, source in columns.items()]
    )


def with_constant_map(df: DataFrame, key: str, mapping: dict, name: str) -> DataFrame:
    """Look a key up in a fixed small dictionary; an unknown key gives null."""
    entries: list[Column] = [F.lit(x) for pair in mapping.items() for x in pair]
    return df.withColumn(name, F.create_map(*entries)[F.col(key)])


def with_lookup(df: DataFrame, lookup: DataFrame, on: str) -> DataFrame:
    """Left join of a lookup table whose size is bounded by a fixed domain (segments, clusters)."""
    return df.join(F.broadcast(lookup), on, "left")
