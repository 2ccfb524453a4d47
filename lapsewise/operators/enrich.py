"""RFM scores and behavioural features."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapsewise import constants as K
from lapsewise.functions.features import FEATURES
from lapsewise.functions.numeric import clip, num, round_even
from lapsewise.operators.clean import describe
from lapsewise.operators.ranks import with_rank_pct


def rfm_parts(df: DataFrame) -> DataFrame:
    """Add recency, frequency and monetary value.

    The largest number of days is a scalar subquery: it runs once and the rows are not joined.
    """
    horizon = df.agg((F.max(num("last_login_days_ago")) + 1.0).alias("horizon")).scalar()
    return df.select(
        "*",
        (horizon - num("last_login_days_ago")).alias("rfm_recency"),
        num("session_count").alias("rfm_frequency"),
        F.log1p(F.coalesce(num("total_spend_usd"), F.lit(0.0))).alias("rfm_monetary"),
    )


def with_rfm(df: DataFrame, key: str = K.ID, **join_options) -> DataFrame:
    """RFM parts plus rfm_score, the mean of their three percentile ranks on a 0-100 scale."""
    ranked = with_rank_pct(
        rfm_parts(df),
        {"rfm_recency": "_r", "rfm_frequency": "_f", "rfm_monetary": "_m"},
        key,
        **join_options,
    )
    score = (F.col("_r") * 100.0 + F.col("_f") * 100.0 + F.col("_m") * 100.0) / 3.0
    return ranked.withColumn("rfm_score", round_even(score, 2)).drop("_r", "_f", "_m")


def serving_rfm(df: DataFrame, cap_days: bool = True) -> DataFrame:
    """RFM columns of a single record, where no population is known: fixed horizon and score."""
    days = num("last_login_days_ago")
    return df.select(
        "*",
        (180.0 - (clip(days, high=180.0) if cap_days else days)).alias("rfm_recency"),
        num("session_count").alias("rfm_frequency"),
        F.log1p(F.coalesce(num("total_spend_usd"), F.lit(0.0))).alias("rfm_monetary"),
        F.lit(50.0).alias("rfm_score"),
    )


def engineer_features(df: DataFrame) -> DataFrame:
    """All nine features in one projection."""
    return df.select("*", *[make().alias(name) for name, make in FEATURES.items()])


def summarise_features(df: DataFrame) -> DataFrame:
    return describe(df, K.ENGINEERED_FEATURES)


def spend_quality(df: DataFrame) -> DataFrame:
    """Rows whose spend is at or below -0.01 and therefore has no tier."""
    return df.where(num("total_spend_usd") <= -0.01)
