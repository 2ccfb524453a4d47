"""Validation of untyped JSON records."""

import json

import pytest

from lapsewise.operators import scoring as V

GOOD = {
    "session_count": 45, "avg_session_duration": 40, "last_login_days_ago": 12, "total_playtime_hours": 80, "win_rate": 0.52,
    "total_spend_usd": 25.0, "friend_count": 8, "game_mode_primary": "PvP", "achievement_count": 35, "consecutive_losses": 2,
}
NUMBER = "(<class 'int'>, <class 'float'>)"
MODES = "game_mode_primary must be one of {'PvP', 'PvE', 'Co-op', 'Solo'}"
CASES = [
    (GOOD, []),
    ({**GOOD, "win_rate": 1.0, "session_count": 10000, "consecutive_losses": 0, "last_login_days_ago": 3650}, []),
    ({**GOOD, "session_count": 1, "avg_session_duration": 1440, "win_rate": 0}, []),
    ({k: v for k, v in GOOD.items() if k != "win_rate"}, ["Missing required field: 'win_rate'"]),
    ({k: v for k, v in GOOD.items() if k != "game_mode_primary"}, ["Missing required field: 'game_mode_primary'"]),
    ({**GOOD, "friend_count": None}, [f"Field 'friend_count' must be {NUMBER}, got NoneType"]),
    ({**GOOD, "friend_count": "8"}, [f"Field 'friend_count' must be {NUMBER}, got str"]),
    ({**GOOD, "friend_count": [8]}, [f"Field 'friend_count' must be {NUMBER}, got list"]),
    ({**GOOD, "friend_count": {"n": 8}}, [f"Field 'friend_count' must be {NUMBER}, got dict"]),
    ({**GOOD, "friend_count": True}, []),
    ({**GOOD, "session_count": False}, ["Field 'session_count' = False is out of range [1, 10000]"]),
    ({**GOOD, "session_count": 0}, ["Field 'session_count' = 0 is out of range [1, 10000]"]),
    ({**GOOD, "session_count": 10001}, ["Field 'session_count' = 10001 is out of range [1, 10000]"]),
    ({**GOOD, "win_rate": 1.5}, ["Field 'win_rate' = 1.5 is out of range [0.0, 1.0]"]),
    ({**GOOD, "win_rate": 2.0}, ["Field 'win_rate' = 2.0 is out of range [0.0, 1.0]"]),
    ({**GOOD, "total_spend_usd": -0.01}, ["Field 'total_spend_usd' = -0.01 is out of range [0.0, 100000]"]),
    ({**GOOD, "total_spend_usd": 12345678.5}, ["Field 'total_spend_usd' = 12345678.5 is out of range [0.0, 100000]"]),
    ({**GOOD, "game_mode_primary": "Arcade"}, [MODES]),
    ({**GOOD, "game_mode_primary": 7}, ["Field 'game_mode_primary' must be <class 'str'>, got int", MODES]),
    ({**GOOD, "game_mode_primary": 7.5}, ["Field 'game_mode_primary' must be <class 'str'>, got float", MODES]),
    ({**GOOD, "game_mode_primary": None}, ["Field 'game_mode_primary' must be <class 'str'>, got NoneType", MODES]),
    ({}, [f"Missing required field: '{k}'" for k in [
        "session_count", "avg_session_duration", "last_login_days_ago", "total_playtime_hours", "win_rate", "total_spend_usd",
        "friend_count", "game_mode_primary", "achievement_count", "consecutive_losses"]]),
]
BROKEN = ["not json", "[1, 2]", "3", '{"session_count": ', "null"]


@pytest.fixture(scope="module")
def checked(spark):
    rows = [(i, json.dumps(record)) for i, (record, _) in enumerate(CASES)] + [(100 + i, t) for i, t in enumerate(BROKEN)]
    return {r["i"]: r for r in V.validate(spark.createDataFrame(rows, "i int, record string")).collect()}


@pytest.mark.parametrize("i", range(len(CASES)))
def test_messages(checked, i):
    assert checked[i]["errors"] == CASES[i][1]


@pytest.mark.parametrize("i", range(len(BROKEN)))
def test_broken_text(checked, i):
    assert checked[100 + i]["errors"] == ["Request body must be valid JSON."]


def test_values_are_typed(checked):
    r = checked[0]
    assert r["session_count"] == 45.0 and r["win_rate"] == 0.52 and r["game_mode_primary"] == "PvP"
    assert checked[9]["friend_count"] == 1.0


def test_response_boundaries(spark):
    df = spark.createDataFrame([(0.55, 1, 2, 3.0, 0.5, 1), (0.5499, 1, 2, 3.0, 0.5, 1)],
                               "p double, session_count int, last_login_days_ago int, total_spend_usd double, win_rate double, consecutive_losses int")
    a, b = V.with_response(df, "p", 0.55).orderBy("p").collect()[::-1]
    assert a["predicted_churn"] is True and b["predicted_churn"] is False
    assert a["churn_probability_pct"] == 55.0 and a["decision_threshold"] == 0.55
    assert a["input_summary"]["consecutive_losses"] == 1


def test_simulator(spark):
    df = spark.createDataFrame([(45, 15, 20.0, 2, 0.5, 5)], "session_count int, last_login_days_ago int, total_spend_usd double, consecutive_losses int, win_rate double, friend_count int")
    r = V.simulator_rows(df).first()
    assert (r["total_playtime_hours"], r["achievement_count"], r["avg_session_duration"], r["game_mode_primary"]) == (33.75, 27, 45.0, "PvP")


def test_serving_queries_derive_the_players_once(spark, sf_dir, monkeypatch):
    from lapsewise.queries import base
    from lapsewise.queries.modelling import stream_scored_records

    derived, own = [], base.player_profile
    monkeypatch.setattr(base, "player_profile", lambda *args: derived.append(1) or own(*args))
    found = stream_scored_records(spark, sf_dir)
    assert len(derived) == 1 and found.count() == base.players(spark, sf_dir).count()
