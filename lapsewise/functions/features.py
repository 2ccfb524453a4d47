"""Row-wise behavioural features, each a column expression over the player table.

Fixed values: weights, caps and fill values are part of the definitions.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

from lapsewise.functions.numeric import clip, num, right_closed_bin, round_even

FILL = {
    "total_spend_usd": 0.0,
    "avg_session_duration": 45.0,
    "win_rate": 0.5,
    "consecutive_losses": 0.0,
    "friend_count": 0.0,
}


def filled(name: str) -> Column:
    return F.coalesce(num(name), F.lit(FILL[name]))


def sessions_floor_one() -> Column:
    return clip(num("session_count"), low=1.0)


def spend_per_session() -> Column:
    return round_even(filled("total_spend_usd") / sessions_floor_one(), 4)


def rolling_avg_sessions_7d() -> Column:
    weekly = num("session_count") / clip(num("last_login_days_ago"), low=7.0)
    return round_even(weekly * 7.0, 2)


def win_rate_trend() -> Column:
    pressure = filled("consecutive_losses") / 15.0
    return round_even(filled("win_rate") - pressure * 0.5, 4)


def engagement_score() -> Column:
    # (weight, signal scaled to 0..1)
    recency = 1.0 - clip(num("last_login_days_ago"), 0.0, 180.0) / 180.0
    frequency = clip(num("session_count"), 0.0, 500.0) / 500.0
    length = clip(filled("avg_session_duration"), 5.0, 240.0) / 240.0
    social = clip(filled("friend_count"), 0.0, 50.0) / 50.0
    blend = 0.40 * recency + 0.25 * frequency + 0.20 * length + 0.15 * social
    return round_even(blend * 100.0, 2)


def loss_streak_risk() -> Column:
    distance = (num("consecutive_losses") - 4.0) / 2.0
    return round_even(1.0 / (1.0 + F.exp(-distance)), 4)


def monetisation_tier() -> Column:
    """0 free, 1 up to 20, 2 up to 100, 3 above; spend at or below -0.01 has no tier (null)."""
    return right_closed_bin(
        filled("total_spend_usd"), [-0.01, 0.0, 20.0, 100.0, float("inf")], [0, 1, 2, 3]
    ).cast("int")


def achievement_velocity() -> Column:
    pace = num("achievement_count") / clip(num("total_playtime_hours"), low=0.5)
    return round_even(clip(pace, high=50.0), 4)


def social_engagement_ratio() -> Column:
    return round_even(filled("friend_count") / sessions_floor_one(), 4)


def spend_recency_interaction() -> Column:
    freshness = F.lit(1.0) / (1.0 + num("last_login_days_ago"))
    return round_even(filled("total_spend_usd") * freshness, 4)


FEATURES = {
    "spend_per_session": spend_per_session,
    "rolling_avg_sessions_7d": rolling_avg_sessions_7d,
    "win_rate_trend": win_rate_trend,
    "engagement_score": engagement_score,
    "loss_streak_risk": loss_streak_risk,
    "monetisation_tier": monetisation_tier,
    "achievement_velocity": achievement_velocity,
    "social_engagement_ratio": social_engagement_ratio,
    "spend_recency_interaction": spend_recency_interaction,
}
