"""Label, tier and text expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from lapsewise import constants as K
from lapsewise.functions.numeric import num, right_closed_bin


def churn_label(days: Column, threshold: int = K.CHURN_DAYS) -> Column:
    """1 when strictly more than ``threshold`` days have passed."""
    return (days > F.lit(threshold)).cast("int")


def churn_status(label: str = K.LABEL) -> Column:
    return F.when(F.col(label) == 0, F.lit("Active")).when(F.col(label) == 1, F.lit("Churned"))


def spend_tier_label(tier: Column) -> Column:
    out = None
    for code, name in enumerate(K.SPEND_TIERS):
        out = F.when(tier == code, F.lit(name)) if out is None else out.when(tier == code, F.lit(name))
    return out


def spend_tier_from_amount(spend: Column) -> Column:
    return right_closed_bin(
        F.coalesce(spend.cast("double"), F.lit(0.0)), [-1.0, 0.0, 20.0, 100.0, float("inf")], K.SPEND_TIERS
    )


def _ladder(prob: Column, steps: list, pick: int) -> Column:
    """Value of the first step whose lower bound the probability reaches."""
    out = F.when(prob.isNull(), F.lit(None).cast("string"))
    for step in steps[:-1]:
        out = out.when(prob >= F.lit(step[0]), F.lit(step[pick]))
    return out.otherwise(F.lit(steps[-1][pick]))


def risk_tier(prob: Column) -> Column:
    return _ladder(prob, K.RISK_TIERS, 1)


def recommendation(prob: Column) -> Column:
    return _ladder(prob, K.RISK_TIERS, 2)


def board_tier(prob: Column) -> Column:
    return _ladder(prob, K.BOARD_TIERS, 1)


def board_message(prob: Column) -> Column:
    return _ladder(prob, K.BOARD_TIERS, 2)


def gauge_band(prob: Column) -> Column:
    pct = prob * 100.0
    return F.when(pct < 30, F.lit("green")).when(pct < 65, F.lit("amber")).when(
        pct.isNotNull(), F.lit("red")
    )


def intervention_tier() -> Column:
    """Who to contact and how soon, from streak, recency, spend and segment."""
    urgent = (num("consecutive_losses") >= 5) & (num("last_login_days_ago") >= 20)
    unspent = F.coalesce(num("total_spend_usd"), F.lit(0.0)) <= 0
    return (
        F.when(urgent, F.lit("Tier 1 (24-48h)"))
        .when((F.col("segment") == "Casual") & unspent, F.lit("Tier 2 (weekly)"))
        .when(F.col("segment").isin("Champions", "Whales"), F.lit("Tier 3 (monthly)"))
        .otherwise(F.lit("None"))
    )
