"""Validation and scoring of JSON records made from the player table."""

from pyspark.sql import functions as F

from lapsewise.operators import scoring as V
from lapsewise.operators.enrich import engineer_features, serving_rfm
from lapsewise import constants as K
from lapsewise.queries.base import PLAYERS, feature_sql, players, query, r, rounded, with_

# Every twentieth player gets a broken record of each kind, chosen by the number in the id.
_FIELDS = [
    ("session_count", "session_count"),
    ("avg_session_duration", "avg_session_duration"),
    ("last_login_days_ago", "last_login_days_ago"),
    ("total_playtime_hours", "total_playtime_hours"),
    ("win_rate", "win_rate"),
    ("total_spend_usd", "total_spend_usd"),
    ("friend_count", "friend_count"),
    ("game_mode_primary", "game_mode_primary"),
    ("achievement_count", "achievement_count"),
    ("consecutive_losses", "consecutive_losses"),
]
_BROKEN = {
    "session_count": {1: "null", 2: '"12"', 11: "0", 12: "10000"},
    "avg_session_duration": {10: "[1]"},
    "last_login_days_ago": {8: "4000"},
    "win_rate": {3: "1.5", 13: "1.0"},
    "total_spend_usd": {6: "-5.0"},
    "friend_count": {7: "true"},
    "game_mode_primary": {4: '"Arcade"', 5: "7"},
    "consecutive_losses": {14: '{"n": 1}', 15: "100.5"},
}


def _record_sql(cast: str) -> str:
    """SQL text (valid in both engines) that builds the JSON record of a player."""
    cells = []
    for name, column in _FIELDS:
        value = f"'\"' || {column} || '\"'" if name == K.MODE else f"CAST({column} AS {cast})"
        value = f"coalesce({value}, 'null')"
        arms = " ".join(f"WHEN k = {rem} THEN '{text}'" for rem, text in _BROKEN.get(name, {}).items())
        cell = f"'\"{name}\": ' || " + (f"CASE {arms} ELSE {value} END" if arms else value)
        if name == "win_rate":
            cell = f"CASE WHEN k = 0 THEN '\"other\": 1' ELSE {cell} END"
        cells.append(cell)
    body = " || ', ' || ".join(cells)
    return f"CASE WHEN k = 9 THEN '{{}}' WHEN k = 16 THEN 'not json' ELSE '{{' || {body} || '}}' END"


def records(spark, sf_dir, rows=None):
    """Request records of the given players, or of those of the tables."""
    df = (players(spark, sf_dir) if rows is None else rows).withColumn("k", F.substring("player_id", 2, 20).cast("bigint") % 20)
    return df.select("player_id", F.expr(_record_sql("string")).alias("record"))


def _errors_sql() -> str:
    """One message per rule, joined with '; '."""
    cells = []
    for name in K.REQUEST_FIELDS:
        kind, text = f"json_type(record, '$.{name}')", f"json_extract_string(record, '$.{name}')"
        name_of = (f"CASE {kind} WHEN 'NULL' THEN 'NoneType' WHEN 'VARCHAR' THEN 'str' WHEN 'BOOLEAN' THEN 'bool' WHEN 'ARRAY' THEN 'list' "
                   f"WHEN 'OBJECT' THEN 'dict' WHEN 'DOUBLE' THEN 'float' ELSE 'int' END")
        missing = f"CASE WHEN {kind} IS NULL THEN 'Missing required field: ''{name}'''"
        if name == K.MODE:
            cells.append(f"{missing} WHEN {kind} <> 'VARCHAR' THEN 'Field ''{name}'' must be <class ''str''>, got ' || {name_of} END")
            continue
        low, high = K.FIELD_BOUNDS[name]
        number = f"CASE {kind} WHEN 'BOOLEAN' THEN CASE WHEN {text} = 'true' THEN 1e0 ELSE 0e0 END ELSE TRY_CAST({text} AS DOUBLE) END"
        cells.append(
            f"{missing} WHEN {kind} NOT IN ('UBIGINT', 'BIGINT', 'DOUBLE', 'BOOLEAN') THEN "
            f"'Field ''{name}'' must be (<class ''int''>, <class ''float''>), got ' || {name_of} "
            f"WHEN {number} < {low} OR {number} > {high} THEN 'Field ''{name}'' = ' || {text} || ' is out of range [{low}, {high}]' END"
        )
    cells.append(
        f"CASE WHEN json_type(record, '$.{K.MODE}') IS NOT NULL AND NOT (json_type(record, '$.{K.MODE}') = 'VARCHAR' AND "
        f"json_extract_string(record, '$.{K.MODE}') IN ('PvP', 'PvE', 'Co-op', 'Solo')) "
        f"THEN 'game_mode_primary must be one of {{''PvP'', ''PvE'', ''Co-op'', ''Solo''}}' END"
    )
    return "concat_ws('; ', " + ", ".join(cells) + ")"


RECORDS = f"""{PLAYERS},
  rc AS (SELECT player_id, {_record_sql("VARCHAR")} AS record FROM (SELECT *, custkey % 20 AS k FROM p)),
  er AS (SELECT player_id, CASE WHEN NOT json_valid(record) THEN 'Request body must be valid JSON.' ELSE {_errors_sql()} END AS errors
         FROM (SELECT player_id, record FROM rc))"""
# json functions must not see the broken text
RECORDS = RECORDS.replace("FROM (SELECT player_id, record FROM rc)", "FROM (SELECT player_id, CASE WHEN json_valid(record) THEN record ELSE NULL END AS record FROM rc)").replace(
    "CASE WHEN NOT json_valid(record) THEN", "CASE WHEN record IS NULL THEN")


@query("validate_records", with_(RECORDS, "SELECT player_id, errors FROM er"))
def validate_records(spark, sf_dir):
    checked = V.validate(records(spark, sf_dir))
    return checked.select("player_id", F.concat_ws("; ", "errors").alias("errors"))


@query("validation_summary", with_(RECORDS, "SELECT errors = '' AS valid, count(*) AS records FROM er GROUP BY 1"))
def validation_summary(spark, sf_dir):
    return V.validate(records(spark, sf_dir)).groupBy(V.is_valid().alias("valid")).agg(F.count(F.lit(1)).alias("records"))


_SCORED = f"""{PLAYERS},\nf AS ({feature_sql('p')}),
  sc AS (SELECT *, 1e0 - engagement_score / 1e2 AS prob FROM f)"""


def _ladder_sql(steps, pick):
    arms = " ".join(f"WHEN prob >= {s[0]}::DOUBLE THEN '{s[pick]}'" for s in steps[:-1])
    return f"CASE {arms} ELSE '{steps[-1][pick]}' END"


def _scored(spark, sf_dir):
    return engineer_features(players(spark, sf_dir)).withColumn("prob", 1.0 - F.col("engagement_score") / 100.0)


@query(
    "response_columns",
    with_(_SCORED, f"""SELECT player_id, {r("prob", 4)} AS churn_probability, {r("prob * 1e2", 1)} AS churn_probability_pct, prob >= 5.5e-1 AS predicted_churn,
      {_ladder_sql(K.RISK_TIERS, 1)} AS risk_tier, 5.5e-1 AS decision_threshold, {_ladder_sql(K.RISK_TIERS, 2)} AS recommendation,
      session_count AS in_sessions, win_rate AS in_win_rate FROM sc"""),
)
def response_columns(spark, sf_dir):
    out = V.with_response(_scored(spark, sf_dir), "prob", 0.55)
    return out.select(
        "player_id", "churn_probability", "churn_probability_pct", "predicted_churn", "risk_tier", "decision_threshold", "recommendation",
        F.col("input_summary.session_count").alias("in_sessions"), F.col("input_summary.win_rate").alias("in_win_rate"),
    )


@query(
    "board_tiers",
    with_(_SCORED, f"""SELECT player_id, {_ladder_sql(K.BOARD_TIERS, 1)} AS tier, {_ladder_sql(K.BOARD_TIERS, 2)} AS message,
      CASE WHEN prob * 1e2 < 30 THEN 'green' WHEN prob * 1e2 < 65 THEN 'amber' ELSE 'red' END AS gauge FROM sc"""),
)
def board_tiers(spark, sf_dir):
    return V.with_board(_scored(spark, sf_dir), "prob").select("player_id", "tier", "message", "gauge")


@query(
    "serving_rfm",
    with_(PLAYERS, f"""SELECT player_id, 180e0 - least(CAST(last_login_days_ago AS DOUBLE), 180e0) AS rfm_recency, CAST(session_count AS DOUBLE) AS rfm_frequency,
      {r("ln(1e0 + coalesce(total_spend_usd, 0e0))", 6)} AS rfm_monetary, 50e0 AS rfm_score FROM p"""),
)
def serving_rfm_query(spark, sf_dir):
    df = players(spark, sf_dir, ["player_id", "last_login_days_ago", "session_count", "total_spend_usd"])
    return rounded(serving_rfm(df).select("player_id", *K.RFM_FEATURES), 6, "rfm_monetary")


@query(
    "simulator_rows",
    with_(PLAYERS, """SELECT player_id, 45e0 AS avg_session_duration, session_count * 45e0 / 60e0 AS total_playtime_hours, 'PvP' AS game_mode_primary,
      CAST(floor(session_count * 0.6::DOUBLE) AS BIGINT) AS achievement_count FROM p"""),
)
def simulator_rows(spark, sf_dir):
    grid = players(spark, sf_dir, ["player_id", "session_count", "last_login_days_ago", "total_spend_usd", "consecutive_losses", "win_rate", "friend_count"])
    return V.simulator_rows(grid).select("player_id", "avg_session_duration", "total_playtime_hours", "game_mode_primary", "achievement_count")
