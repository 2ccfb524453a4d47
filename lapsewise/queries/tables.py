"""Player table, its feeders, sources and sinks."""

from pyspark.sql import functions as F

from lapsewise import constants as K
from lapsewise.functions.features import monetisation_tier
from lapsewise.functions.labels import churn_label
from lapsewise.functions.numeric import round_even
from lapsewise.operators import profile as P
from lapsewise.operators.clean import board_filter, null_profile
from lapsewise.operators.enrich import engineer_features
from lapsewise.operators.scoring import is_valid, validate
from lapsewise.operators.split import hash_split, split_audit
from lapsewise.queries.base import (
    FEATURED,
    PLAYERS,
    feature_sql,
    featured,
    players,
    query,
    r,
    rounded,
    winsorised,
    with_,
)
from lapsewise.queries.segments import RULE_SQL, segmented_only
from lapsewise.sources import sinks
from lapsewise.sources.tables import load_json_records, load_players, load_splits, read_table
from lapsewise.sources.workspace import new_path

_COLUMNS = (
    "player_id, session_count, avg_session_duration, last_login_days_ago, total_playtime_hours, win_rate, "
    "total_spend_usd, friend_count, game_mode_primary, achievement_count, consecutive_losses, churn_label"
)
_MODE_SUMMARY = f"""SELECT game_mode_primary AS game_mode, {r("avg(CAST(churn_label AS DOUBLE))", 6)} AS churn_rate,
  count(*) AS player_count, {r("avg(engagement_score)", 4)} AS mean_engagement
  FROM f WHERE game_mode_primary IS NOT NULL GROUP BY 1"""


def mode_summary(df):
    """Churn rate and mean engagement by game mode over raw players with features."""
    return engineer_features(df).where(F.col(K.MODE).isNotNull()).groupBy(F.col(K.MODE).alias("game_mode")).agg(
        round_even(F.avg(F.col(K.LABEL).cast("double")), 6).alias("churn_rate"),
        F.count(F.lit(1)).alias("player_count"),
        round_even(F.avg("engagement_score"), 4).alias("mean_engagement"),
    )


@query("churn_and_engagement_by_mode", with_(f"{PLAYERS},\nf AS ({feature_sql('p')})", _MODE_SUMMARY))
def churn_and_engagement_by_mode(spark, sf_dir):
    return mode_summary(players(spark, sf_dir))


@query("player_profile", with_(PLAYERS, f"SELECT {_COLUMNS}, strftime(join_date, '%Y-%m-%d') AS join_date FROM p"))
def player_profile(spark, sf_dir):
    return players(spark, sf_dir).withColumn("join_date", F.date_format("join_date", "yyyy-MM-dd"))


@query(
    "customer_recency",
    """SELECT o_custkey, CAST(datediff('day', CAST(max(o_orderdate) AS DATE),
         CAST((SELECT max(o_orderdate) FROM orders) AS DATE)) AS BIGINT) AS days FROM orders GROUP BY 1""",
)
def customer_recency(spark, sf_dir):
    orders = read_table(spark, sf_dir, "orders")
    as_of = orders.agg(F.max("o_orderdate").alias("d")).scalar()
    return orders.groupBy("o_custkey").agg(F.max("o_orderdate").alias("seen")).select(
        "o_custkey", P.recency(F.col("seen"), as_of).alias("days")
    )


@query(
    "loss_streak",
    """WITH seq AS (SELECT o_custkey, o_orderstatus = 'F' AS lost,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders)
       SELECT o_custkey, CAST(coalesce(min(CASE WHEN NOT lost THEN rn END) - 1, count(*)) AS BIGINT) AS streak
       FROM seq GROUP BY 1""",
)
def loss_streak(spark, sf_dir):
    orders = read_table(spark, sf_dir, "orders")
    return P.loss_streak(orders, "o_custkey", ["o_orderdate", "o_orderkey"], F.col("o_orderstatus") == "F")


@query(
    "churn_labels",
    with_(PLAYERS, """SELECT player_id, CAST(last_login_days_ago > 30 AS INTEGER) AS churn_30,
      CAST(last_login_days_ago > 180 AS INTEGER) AS churn_180 FROM p"""),
)
def churn_labels(spark, sf_dir):
    df = players(spark, sf_dir, ["player_id", "last_login_days_ago"])
    days = F.col("last_login_days_ago")
    return df.select("player_id", churn_label(days).alias("churn_30"), churn_label(days, 180).alias("churn_180"))


@query(
    "inject_nulls",
    """SELECT 'c_acctbal' AS "column", count(*) FILTER (WHERE c_custkey % 50 = 3) AS nulls FROM customer
       UNION ALL SELECT 'c_mktsegment', count(*) FILTER (WHERE c_custkey % 50 = 11) FROM customer""",
)
def inject_nulls(spark, sf_dir):
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    return null_profile(P.inject_nulls(customer, {"c_acctbal": 3, "c_mktsegment": 11}, "c_custkey"))


# ---- sources and sinks ------------------------------------------------------------------------

@query("load_players_csv", with_(PLAYERS, f"SELECT {_COLUMNS} FROM p"))
def load_players_csv(spark, sf_dir):
    df = players(spark, sf_dir).drop("join_date")
    return load_players(spark, sinks.write_players(df, new_path(spark, "players-csv"), "csv"))


@query("load_players_parquet", with_(PLAYERS, f"SELECT {_COLUMNS} FROM p"))
def load_players_parquet(spark, sf_dir):
    df = players(spark, sf_dir).drop("join_date")
    return load_players(spark, sinks.write_players(df, new_path(spark, "players-parquet")), "parquet")


HASH_SQL = "(CAST(CAST('0x' || substr(md5(player_id || '#42'), 1, 8) AS BIGINT) AS DOUBLE) / 4294967296e0)"
SPLIT_SQL = f"CASE WHEN {HASH_SQL} < 0.7::DOUBLE THEN 'train' WHEN {HASH_SQL} < 0.7::DOUBLE + 0.15::DOUBLE THEN 'val' ELSE 'test' END"


@query(
    "load_one_split",
    with_(PLAYERS, f"""SELECT player_id, CAST(session_count AS BIGINT) AS session_count, churn_label FROM p WHERE {SPLIT_SQL} = 'val'"""),
)
def load_one_split(spark, sf_dir):
    df = hash_split(players(spark, sf_dir, ["player_id", "session_count", "churn_label"]))
    path = sinks.write_splits(df, new_path(spark, "splits"))
    return load_splits(spark, path, "val").drop("split")


@query(
    "write_and_audit_splits",
    with_(PLAYERS, f"""SELECT {SPLIT_SQL} AS split, count(*) AS players, {r("avg(CAST(churn_label AS DOUBLE)) * 1e2", 6)} AS churn_pct FROM p GROUP BY 1"""),
)
def write_and_audit_splits(spark, sf_dir):
    path = sinks.write_splits(hash_split(players(spark, sf_dir, ["player_id", "churn_label"])), new_path(spark, "splits"))
    return rounded(split_audit(load_splits(spark, path)), 6, "churn_pct")


@query("write_featured_players", with_(FEATURED, f"""SELECT count(*) AS rows, {r("sum(engagement_score)", 2)} AS engagement,
  {r("sum(rfm_score)", 2)} AS rfm FROM f"""))
def write_featured_players(spark, sf_dir):
    path = sinks.write_players(featured(spark, sf_dir), new_path(spark, "featured"))
    return spark.read.parquet(path).agg(
        F.count(F.lit(1)).alias("rows"), round_even(F.sum("engagement_score"), 2).alias("engagement"),
        round_even(F.sum("rfm_score"), 2).alias("rfm"),
    )


@query("write_report_csv", with_(PLAYERS, """SELECT game_mode_primary AS game_mode, count(*) AS players FROM p GROUP BY 1"""))
def write_report_csv(spark, sf_dir):
    report = players(spark, sf_dir, ["game_mode_primary"]).groupBy(F.col("game_mode_primary").alias("game_mode")).agg(
        F.count(F.lit(1)).alias("players")
    )
    path = sinks.write_report(report, new_path(spark, "report"))
    return spark.read.schema("game_mode string, players bigint").option("header", True).csv(path)


@query(
    "json_records_round_trip",
    with_(PLAYERS, """SELECT count(*) AS records, count(*) FILTER (WHERE avg_session_duration IS NOT NULL AND win_rate IS NOT NULL
      AND total_spend_usd IS NOT NULL AND friend_count IS NOT NULL AND avg_session_duration >= 1) AS valid FROM p"""),
)
def json_records_round_trip(spark, sf_dir):
    path = sinks.write_json_records(players(spark, sf_dir), new_path(spark, "records"))
    checked = validate(load_json_records(spark, path))
    return checked.agg(F.count(F.lit(1)).alias("records"), F.count(F.when(is_valid(), 1)).alias("valid"))


@query(
    "export_segment_view",
    with_(f"{FEATURED},\n{RULE_SQL}", """SELECT player_id, segment, session_count, last_login_days_ago, total_spend_usd, win_rate,
      churn_label FROM s WHERE segment = 'At-Risk'"""),
)
def export_segment_view(spark, sf_dir):
    df = segmented_only(spark, sf_dir, "win_rate", "churn_label")
    path = sinks.export_view(df, new_path(spark, "export"), "At-Risk")
    return spark.read.schema(
        "player_id string, segment string, session_count double, last_login_days_ago double, total_spend_usd double, "
        "win_rate double, churn_label int"
    ).option("header", True).csv(path)


@query(
    "board_filter",
    with_(FEATURED, """SELECT player_id, game_mode_primary, churn_label, monetisation_tier FROM f
      WHERE game_mode_primary IN ('PvP', 'Solo') AND churn_label = 0 AND monetisation_tier IN (1, 2)"""),
)
def board_filter_query(spark, sf_dir):
    # tier and mode don't depend on ranks; the filter on mode and label reaches the stored players
    df = winsorised(spark, sf_dir, ["player_id", "game_mode_primary", "churn_label", "total_spend_usd"])
    shown = board_filter(df.withColumn("monetisation_tier", monetisation_tier()), ["PvP", "Solo"], ["Active"], ["Minnow", "Dolphin"])
    return shown.select("player_id", "game_mode_primary", "churn_label", "monetisation_tier")


@query(
    "raw_board_filter",
    with_(PLAYERS, """SELECT player_id, CASE WHEN coalesce(total_spend_usd, 0e0) <= 0 THEN 'Free' WHEN total_spend_usd <= 20 THEN 'Minnow'
        WHEN total_spend_usd <= 100 THEN 'Dolphin' ELSE 'Whale' END AS spend_tier_label FROM p
      WHERE churn_label = 1 AND game_mode_primary IS NOT NULL"""),
)
def raw_board_filter(spark, sf_dir):
    df = players(spark, sf_dir, ["player_id", "game_mode_primary", "churn_label", "total_spend_usd"])
    return board_filter(df, statuses=["Churned"]).select("player_id", "spend_tier_label")
