"""Golden rows for formulas and boundaries."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lapsewise import constants as K
from lapsewise.functions import features as X
from lapsewise.functions import labels as L
from lapsewise.functions import numeric as N
from lapsewise.operators.enrich import engineer_features, spend_quality


def one(spark, values, expr, kind="double"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select("i", expr(F.col("x")).alias("y")).orderBy("i").select("y").collect()]


def test_round_even(spark):
    assert one(spark, [0.125, 2.675, 1.005, -0.125, None], lambda c: N.round_even(c, 2)) == [0.12, 2.68, 1.0, -0.12, None]
    values = np.random.default_rng(1).normal(0, 100, 500).tolist()
    want = [float(np.rint(v * 1e4)) / 1e4 for v in values]
    assert one(spark, values, lambda c: N.round_even(c, 4)) == want


def test_clip_keeps_null(spark):
    assert one(spark, [None, -1.0, 0.5, 9.0], lambda c: N.clip(c, 0.0, 1.0)) == [None, 0.0, 0.5, 1.0]


def test_nan_and_ratio(spark):
    assert one(spark, [float("nan"), 1.0], N.nan_to_null) == [None, 1.0]
    assert one(spark, [0.0, 2.0], lambda c: N.ratio(F.lit(1), c)) == [None, 0.5]


@pytest.mark.parametrize("bins, values, want", [
    (K.LOSS_BINS, [0, 1, 2, 3, 4, 5, 6, 7, 10, 11, 15, 16, -1], ["0", "1-2", "1-2", "3-4", "3-4", "5-6", "5-6", "7-10", "7-10", "11+", "11+", "11+", None]),
    (K.FRIEND_BINS, [0, 2, 3, 5, 6, 10, 11, 20, 21, 50, 51, 200, 201, 10_000], ["0", "1-2", "3-5", "3-5", "6-10", "6-10", "11-20", "11-20", "21-50", "21-50", "50+", "50+", "50+", "50+"]),
])
def test_right_closed_bins(spark, bins, values, want):
    assert one(spark, values, lambda c: N.right_closed_bin(c, *bins), "int") == want


def test_equal_width(spark):
    values = [0.0, 0.1, 0.55, 0.95, 1.0]
    assert one(spark, values, lambda c: N.equal_width_bin(c, F.lit(0.0), F.lit(1.0), 10)) == [0, 1, 5, 9, 9]
    assert one(spark, [0.0, 0.1, 0.11, 1.0], lambda c: N.equal_width_cut(c, F.lit(0.0), F.lit(1.0), 10)) == [0, 0, 1, 9]
    assert one(spark, [3.0], lambda c: N.equal_width_bin(c, F.lit(3.0), F.lit(3.0), 10)) == [0]


def test_churn_label_is_strict(spark):
    assert one(spark, [29, 30, 31], lambda c: L.churn_label(c), "bigint") == [0, 0, 1]


def test_risk_tiers(spark):
    probs = [0.2499, 0.25, 0.4999, 0.50, 0.7499, 0.75, 1.0, None]
    assert one(spark, probs, L.risk_tier) == ["Minimal", "Low", "Low", "Medium", "Medium", "High", "High", None]
    assert one(spark, probs, L.board_tier) == [
        "Low Risk", "Low Risk", "Low Risk", "Medium Risk", "Medium Risk", "High Risk", "High Risk", None
    ]
    assert one(spark, [0.2999, 0.30, 0.6499, 0.65, None], L.gauge_band) == ["green", "amber", "amber", "red", None]


def test_spend_tiers(spark):
    amounts = [None, 0.0, 0.01, 20.0, 20.01, 100.0, 100.01]
    names = ["Free", "Free", "Minnow", "Minnow", "Dolphin", "Dolphin", "Whale"]
    assert one(spark, amounts, L.spend_tier_from_amount) == names
    df = spark.createDataFrame([(i, v) for i, v in enumerate(amounts)], "i int, total_spend_usd double")
    tiers = [r[0] for r in df.orderBy("i").select(X.monetisation_tier()).collect()]
    assert tiers == [0, 0, 1, 1, 2, 2, 3]
    bad = spark.createDataFrame([(-0.01,), (-5.0,), (0.0,)], "total_spend_usd double")
    assert [r[0] for r in bad.select(X.monetisation_tier()).collect()] == [None, None, 0]
    assert spend_quality(bad).count() == 2


SCHEMA = (
    "player_id string, session_count bigint, avg_session_duration double, last_login_days_ago bigint, "
    "total_playtime_hours double, win_rate double, total_spend_usd double, friend_count bigint, "
    "game_mode_primary string, achievement_count bigint, consecutive_losses bigint"
)


def test_features_by_hand(spark):
    rows = [
        ("A", 45, 40.0, 12, 80.0, 0.52, 25.0, 8, "PvP", 35, 2),
        ("B", 0, None, 0, 0.1, None, None, None, "Solo", 500, None),
        ("C", 900, 999.0, 400, 10.0, 0.3, 150.0, 70, "PvE", 3, 15),
    ]
    got = {r["player_id"]: r for r in engineer_features(spark.createDataFrame(rows, SCHEMA)).collect()}
    a, b, c = got["A"], got["B"], got["C"]
    assert a["spend_per_session"] == 0.5556
    assert a["rolling_avg_sessions_7d"] == 26.25
    assert a["win_rate_trend"] == 0.4533
    assert a["engagement_score"] == round(100 * (0.4 * (1 - 12 / 180) + 0.25 * 45 / 500 + 0.2 * 40 / 240 + 0.15 * 8 / 50), 2)
    assert a["loss_streak_risk"] == round(1 / (1 + math.exp(1)), 4)
    assert a["achievement_velocity"] == 0.4375 and a["social_engagement_ratio"] == 0.1778
    assert a["spend_recency_interaction"] == 1.9231
    assert b["spend_per_session"] == 0.0 and b["win_rate_trend"] == 0.5 and b["loss_streak_risk"] is None
    assert b["achievement_velocity"] == 50.0 and b["monetisation_tier"] == 0
    assert b["engagement_score"] == 43.75
    assert c["engagement_score"] == 60.0 and c["rolling_avg_sessions_7d"] == 15.75 and c["monetisation_tier"] == 3


def test_intervention(spark):
    rows = [("Casual", 5, 20, 0.0), ("Casual", 4, 20, 0.0), ("Casual", 0, 5, 3.0), ("Whales", 0, 5, 90.0), ("At-Risk", 5, 19, None)]
    df = spark.createDataFrame(rows, "segment string, consecutive_losses int, last_login_days_ago int, total_spend_usd double")
    got = [r[0] for r in df.select(L.intervention_tier()).collect()]
    assert got == ["Tier 1 (24-48h)", "Tier 2 (weekly)", "None", "Tier 3 (monthly)", "None"]
