"""Train / validation / test split, folds, class weights."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapsewise import constants as K
from lapsewise.functions.numeric import hash_unit
from lapsewise.operators.ranks import into_ranges, running_totals


def split_of(share: Column, train: float, val: float) -> Column:
    return (
        F.when(share < train, F.lit("train")).when(share < train + val, F.lit("val")).otherwise(F.lit("test"))
    )


def hash_split(df: DataFrame, key: str = K.ID, train: float = 0.70, val: float = 0.15, seed: int = 42) -> DataFrame:
    """Add ``split`` from a hash of the key: no shuffle, stable for a player over time.

    Class shares match in expectation only; ``exact_split`` makes them match by count.
    """
    return df.withColumn("split", split_of(hash_unit(F.col(key), seed), train, val))


def shuffled_position(df: DataFrame, key: str, stratum: str, seed: int) -> DataFrame:
    """(key, stratum, cum_n, total_n): position of each row in a seeded shuffle of its stratum."""
    shuffled = df.select(
        key, stratum, F.concat_ws("#", F.md5(F.concat(F.col(key), F.lit(f"#{seed}"))), F.col(key)).alias("_order"),
        F.lit(1).cast("bigint").alias("n"),
    )
    return running_totals(into_ranges(shuffled, "_order", [stratum]), "_order", ["n"], [stratum]).drop("_order", "n")


def exact_split(
    df: DataFrame, key: str = K.ID, stratum: str = K.LABEL, train: float = 0.70, val: float = 0.15, seed: int = 42
) -> DataFrame:
    """Add ``split`` so that every stratum is cut at its rounded shares."""
    placed = shuffled_position(df, key, stratum, seed)
    train_end = F.rint(F.col("total_n") * train)
    val_end = F.rint(F.col("total_n") * (train + val))
    cut = (
        F.when(F.col("cum_n") <= train_end, F.lit("train"))
        .when(F.col("cum_n") <= val_end, F.lit("val"))
        .otherwise(F.lit("test"))
    )
    return df.join(placed.select(key, cut.alias("split")), key)


def split_audit(df: DataFrame, label: str = K.LABEL) -> DataFrame:
    return df.groupBy("split").agg(
        F.count(F.lit(1)).alias("players"), (F.avg(F.col(label).cast("double")) * 100.0).alias("churn_pct")
    )


def split_overlap(df: DataFrame, key: str = K.ID) -> DataFrame:
    """Keys that are in more than one split; empty when the split is sound."""
    return df.groupBy(key).agg(F.min("split").alias("a"), F.max("split").alias("b")).where("a <> b").select(key)


def with_folds(df: DataFrame, folds: int = 5, key: str = K.ID, stratum: str = K.LABEL, seed: int = 42) -> DataFrame:
    """Add ``fold``: every stratum is dealt out in turn, so fold sizes differ by at most one."""
    placed = shuffled_position(df, key, stratum, seed)
    return df.join(placed.select(key, F.pmod(F.col("cum_n") - 1, F.lit(folds)).cast("int").alias("fold")), key)


def class_distribution(df: DataFrame, label: str = K.LABEL) -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("players"))


def class_weights(df: DataFrame, label: str = K.LABEL) -> DataFrame:
    """(label, weight): rows / (classes x rows of the class)."""
    counts = class_distribution(df, label)
    whole = counts.agg(F.sum("players").alias("rows"), F.count(F.lit(1)).alias("classes"))
    rows, classes = whole.select("rows").scalar(), whole.select("classes").scalar()
    return counts.select(label, (rows / (classes * F.col("players"))).cast("double").alias("weight"))


def with_class_weight(df: DataFrame, label: str = K.LABEL) -> DataFrame:
    """The weight table has one row per class, so it is broadcast."""
    return df.join(F.broadcast(class_weights(df, label)), label, "left")
