"""Per-player attributions, global importance and plain-language risk reasons.

Attributions are a long table (player_id, feature, value, contribution) over all players.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lapsewise import constants as K
from lapsewise.functions.numeric import num
from lapsewise.operators.tree_paths import cells, tree_attributions


def feature_means(matrix: DataFrame, features: list[str]) -> dict[str, float]:
    row = matrix.agg(*[F.avg(num(c)).alias(c) for c in features]).first()
    return {c: row[c] for c in features}


def linear_contributions(
    matrix: DataFrame, features: list[str], coefficients: list[float], means: dict[str, float] | None = None, key: str = K.ID
) -> DataFrame:
    """Exact attribution of a linear score: coefficient x (value - mean of the background).

    Without ``means`` the background is the matrix itself.
    """
    means = means or feature_means(matrix, features)
    cells = F.array(*[
        F.struct(
            F.lit(c).alias("feature"), num(c).alias("value"),
            (F.lit(float(w)) * (num(c) - F.lit(float(means[c])))).alias("contribution"),
        )
        for c, w in zip(features, coefficients)
    ])
    return matrix.select(key, F.inline(cells))


def tree_contributions(matrix: DataFrame, features: list[str], model, key: str = K.ID) -> DataFrame:
    """Path-dependent attributions of a tree ensemble, one row for each player and feature; base + sum = model output."""
    return tree_attributions(matrix, features, model, key).select(key, F.inline(cells(features)))


def contributions(
    matrix: DataFrame, features: list[str], model, means: dict[str, float] | None = None, key: str = K.ID
) -> DataFrame:
    """Attributions of any of the candidate models; ``means`` matters to the linear one only."""
    if hasattr(model, "trees"):
        return tree_contributions(matrix, features, model, key)
    return linear_contributions(matrix, features, list(model.coefficients), means, key)


def global_importance(attributions: DataFrame) -> DataFrame:
    return attributions.groupBy("feature").agg(F.avg(F.abs("contribution")).alias("mean_abs_contribution"))


def top_features(attributions: DataFrame, shown: int = 15, kept: int = 10) -> DataFrame:
    ranked = global_importance(attributions).orderBy(F.desc("mean_abs_contribution"), "feature")
    return ranked.limit(min(shown, kept))


def beeswarm(attributions: DataFrame, shown: int = 15) -> DataFrame:
    """(feature, value, contribution) of all players for the most important features."""
    names = top_features(attributions, shown, shown).select("feature")
    return attributions.join(F.broadcast(names), "feature", "left_semi")


def waterfall(attributions: DataFrame, scored: DataFrame, base: float, shown: int = 12, key: str = K.ID) -> DataFrame:
    """Ordered contributions of the player with the highest probability (smallest id on ties).

    Features beyond the ``shown`` - 1 largest are one row, so base and contributions add up to the score.
    """
    chosen = scored.orderBy(F.desc("churn_prob"), key).limit(1).select(key)
    own = attributions.join(F.broadcast(chosen), key, "left_semi")
    largest = W.partitionBy(key).orderBy(F.desc(F.abs("contribution")), "feature")
    own = own.withColumn("_place", F.row_number().over(largest)).withColumn("_all", F.count("*").over(W.partitionBy(key)))
    alone = (F.col("_place") < shown) | (F.col("_all") <= shown)
    rows = own.groupBy(key, F.when(alone, F.col("feature")).otherwise(F.lit("other features")).alias("feature")).agg(
        F.max(F.when(alone, F.col("value"))).alias("value"), F.sum("contribution").alias("contribution"), F.min("_place").alias("_place")
    )
    return rows.orderBy("_place").drop("_place").withColumn("base_value", F.lit(base))


def top_reasons(attributions: DataFrame, n: int = 3, key: str = K.ID) -> DataFrame:
    """(key, reasons): the n largest contributions by size; a player has one row per feature."""
    cell = F.struct(
        (-F.abs("contribution")).alias("order"), F.col("feature"), F.col("contribution")
    )
    listed = attributions.groupBy(key).agg(F.sort_array(F.collect_list(cell)).alias("all"))
    return listed.select(key, F.slice("all", 1, n).alias("reasons"))


def plain_number(value: Column) -> Column:
    """Whole numbers without decimals, others as they are; null reads 'unknown'."""
    x = value.cast("double")
    return F.coalesce(
        F.when(x == F.floor(x), x.cast("bigint").cast("string")).otherwise(x.cast("string")), F.lit("unknown")
    )


def reason_text(reason: Column) -> Column:
    """One reason as text. The wording and the order of the rules."""
    name = reason["feature"]
    trend = F.when(reason["contribution"] > 0, F.lit("increases")).otherwise(F.lit("decreases"))
    tail = F.concat(F.lit(" ("), trend, F.lit(" churn risk)"))
    spend = F.concat(F.lit("$"), F.rint(num("total_spend_usd")).cast("bigint").cast("string"))
    win = F.concat(F.rint(num("win_rate") * 100.0).cast("bigint").cast("string"), F.lit("%"))
    friends = F.concat(num("friend_count").cast("bigint").cast("string"), F.lit(" in-game friends"))
    described = F.create_map(*[F.lit(x) for pair in K.FEATURE_DESCRIPTIONS.items() for x in pair])
    return (
        F.when(name.contains("last_login"), F.concat(F.lit("Last login "), plain_number(F.col("last_login_days_ago")), F.lit(" days ago"), tail))
        .when(name.contains("consecutive_losses"), F.concat(plain_number(F.col("consecutive_losses")), F.lit(" consecutive losses"), tail))
        .when(F.lower(name).contains("spend"), F.concat(F.lit("Total spend "), F.coalesce(spend, F.lit("unknown")), tail))
        .when(name.contains("session_count"), F.concat(plain_number(F.col("session_count")), F.lit(" sessions total"), tail))
        .when(name.contains("win_rate"), F.concat(F.lit("Win rate "), F.coalesce(win, F.lit("unknown")), tail))
        .when(name.contains("friend_count"), F.concat(F.coalesce(friends, F.lit("Friend count unknown")), tail))
        .otherwise(F.concat(F.lit("Feature '"), F.coalesce(F.try_element_at(described, name), name), F.lit("' "), trend, F.lit(" churn risk")))
    )


def risk_narrative(reasons: Column) -> Column:
    return F.concat_ws(" | ", F.transform(reasons, reason_text))


def top_risk(scored: DataFrame, n: int = 20, key: str = K.ID) -> DataFrame:
    return scored.orderBy(F.desc("churn_prob"), key).limit(n)


def risk_table(
    scored: DataFrame, attributions: DataFrame, players: DataFrame, threshold: float, n: int = 20, key: str = K.ID
) -> DataFrame:
    """The n players most at risk with reasons. The limit comes first, so the joins are n rows wide."""
    listed = top_risk(scored.select(key, "churn_prob", F.col(K.LABEL).alias("actual_churn")), n, key)
    few = F.broadcast(listed)
    reasons = top_reasons(attributions.join(few, key, "left_semi"), key=key)
    facts = players.join(few, key, "left_semi").select(
        key, "last_login_days_ago", "consecutive_losses", "total_spend_usd", "session_count", "win_rate", "friend_count"
    )
    return listed.join(reasons, key).join(facts, key).select(
        key,
        "churn_prob",
        (F.col("churn_prob") >= threshold).cast("int").alias("predicted_churn"),
        "actual_churn",
        risk_narrative(F.col("reasons")).alias("risk_narrative"),
    ).orderBy(F.desc("churn_prob"), key)
