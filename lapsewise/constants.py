"""Names, bounds and texts that results depend on.

Fixed values: every list, bound and sentence below has to stay as it is, because it shows up
in results (column names, validation messages, recommendations, strategy texts).
"""

ID = "player_id"
LABEL = "churn_label"
MODE = "game_mode_primary"

NUMERIC_FEATURES = [
    "session_count",
    "avg_session_duration",
    "last_login_days_ago",
    "total_playtime_hours",
    "win_rate",
    "total_spend_usd",
    "friend_count",
    "achievement_count",
    "consecutive_losses",
]
RFM_FEATURES = ["rfm_recency", "rfm_frequency", "rfm_monetary", "rfm_score"]
ENGINEERED_FEATURES = [
    "spend_per_session",
    "rolling_avg_sessions_7d",
    "win_rate_trend",
    "engagement_score",
    "loss_streak_risk",
    "monetisation_tier",
    "achievement_velocity",
    "social_engagement_ratio",
    "spend_recency_interaction",
]
CLUSTER_FEATURES = [
    "session_count",
    "avg_session_duration",
    "last_login_days_ago",
    "total_spend_usd",
    "win_rate",
    "friend_count",
    "achievement_count",
    "consecutive_losses",
    "engagement_score",
    "spend_per_session",
    "rolling_avg_sessions_7d",
    "rfm_score",
    "loss_streak_risk",
]
PROFILE_FEATURES = [
    "session_count",
    "avg_session_duration",
    "last_login_days_ago",
    "total_spend_usd",
    "win_rate",
    "friend_count",
    "achievement_count",
    "consecutive_losses",
    "churn_label",
]
RADAR_FEATURES = [
    "session_count",
    "avg_session_duration",
    "win_rate",
    "total_spend_usd",
    "friend_count",
    "achievement_count",
]
# Columns that restate the label and can be left out of training.
LABEL_PROXIES = ["last_login_days_ago", "rfm_recency", "rfm_score"]

GAME_MODES = ["PvP", "PvE", "Co-op", "Solo"]
SEGMENTS = ["Champions", "Whales", "Casual", "At-Risk"]
SPEND_TIERS = ["Free", "Minnow", "Dolphin", "Whale"]
STATUSES = ["Active", "Churned"]

# Right-closed bins: label of (edge[i], edge[i + 1]]; the last one is open.
LOSS_BINS = ([-1, 0, 2, 4, 6, 10, float("inf")], ["0", "1-2", "3-4", "5-6", "7-10", "11+"])
FRIEND_BINS = (
    [-1, 0, 2, 5, 10, 20, 50, float("inf")],
    ["0", "1-2", "3-5", "6-10", "11-20", "21-50", "50+"],
)

CHURN_DAYS = 30

# Scoring request: inclusive bounds in request order.
FIELD_BOUNDS = {
    "session_count": ("1", "10000"),
    "avg_session_duration": ("1", "1440"),
    "last_login_days_ago": ("0", "3650"),
    "total_playtime_hours": ("0", "50000"),
    "win_rate": ("0.0", "1.0"),
    "total_spend_usd": ("0.0", "100000"),
    "friend_count": ("0", "10000"),
    "achievement_count": ("0", "10000"),
    "consecutive_losses": ("0", "100"),
}
REQUEST_FIELDS = [
    "session_count",
    "avg_session_duration",
    "last_login_days_ago",
    "total_playtime_hours",
    "win_rate",
    "total_spend_usd",
    "friend_count",
    "game_mode_primary",
    "achievement_count",
    "consecutive_losses",
]
NUMBER_TYPES_TEXT = "(<class 'int'>, <class 'float'>)"
STRING_TYPE_TEXT = "<class 'str'>"
MODES_TEXT = "{'PvP', 'PvE', 'Co-op', 'Solo'}"

SUMMARY_FIELDS = [
    "session_count",
    "last_login_days_ago",
    "total_spend_usd",
    "win_rate",
    "consecutive_losses",
]

# (lowest probability, tier, recommendation), highest first.
RISK_TIERS = [
    (
        0.75,
        "High",
        "Urgent re-engagement: trigger win-back push notification, "
        "offer free premium currency, and adjust matchmaking difficulty.",
    ),
    (
        0.50,
        "Medium",
        "Proactive retention: send a personalised daily login bonus offer "
        "and highlight new content or events.",
    ),
    (
        0.25,
        "Low",
        "Maintain engagement: standard email newsletter, "
        "seasonal event notifications.",
    ),
    (0.0, "Minimal", "Player is highly engaged. Focus on monetisation opportunities."),
]
# (lowest probability, tier, message) of the three-level board.
BOARD_TIERS = [
    (
        0.75,
        "High Risk",
        "**Urgent** — This player is highly likely to churn. "
        "Trigger a win-back campaign immediately.",
    ),
    (
        0.50,
        "Medium Risk",
        "**At risk** — Monitor this player closely. "
        "Consider a personalised offer or difficulty adjustment.",
    ),
    (0.0, "Low Risk", "**Healthy** — This player shows strong engagement signals."),
]

RETENTION_STRATEGIES = {
    "Champions": (
        "Champions are your most engaged and skilled players. "
        "Strategy: Recognise with prestige badges and exclusive cosmetics. "
        "Invite to beta programmes and player councils. Convert to brand advocates "
        "via referral rewards and leaderboard spotlights. "
        "Budget: Low spend required — focus on recognition, not discounts."
    ),
    "Whales": (
        "Whales drive disproportionate revenue. Losing one Whale equals dozens of Casuals. "
        "Strategy: Assign a VIP account manager. Offer exclusive seasonal packs, "
        "early-access content, and personalised offers based on spend history. "
        "Monitor for signs of fatigue (declining session frequency) and trigger "
        "personalised win-back campaigns proactively. "
        "Budget: High — ROI is extremely favourable."
    ),
    "Casual": (
        "Casual players are acquisition successes but not yet converted to paying customers. "
        "Strategy: Tutorial completion incentives, first-purchase discount bundles ($0.99 starter pack), "
        "and social features prompts (invite a friend for bonus currency). "
        "Daily login streaks and limited-time events increase session frequency. "
        "Budget: Medium — aim for conversion to Dolphin tier within 30 days."
    ),
    "At-Risk": (
        "At-Risk players show leading indicators of imminent churn (low recency, declining sessions, "
        "high loss streaks). A 24–48 hour intervention window exists before permanent churn. "
        "Strategy: Triggered push notification ('We miss you — here are 500 free coins!'), "
        "temporary difficulty reduction or matchmaking adjustment, and win-streak reward events. "
        "Analyse common exit points (which level / game mode before churn) for UX fixes. "
        "Budget: Medium — cost of re-engagement is far lower than new acquisition."
    ),
}

FEATURE_DESCRIPTIONS = {
    "last_login_days_ago": "days since last login",
    "session_count": "total play sessions",
    "consecutive_losses": "consecutive losses",
    "total_spend_usd": "total spend ($)",
    "win_rate": "win rate",
    "rfm_score": "RFM engagement score",
    "rfm_recency": "recency score",
    "rfm_frequency": "frequency score",
    "rfm_monetary": "monetary score (log1p)",
    "engagement_score": "engagement score",
    "loss_streak_risk": "loss-streak risk",
    "rolling_avg_sessions_7d": "sessions (last 7 days)",
    "spend_per_session": "spend per session ($)",
    "achievement_velocity": "achievements per hour",
    "social_engagement_ratio": "social engagement ratio",
}
