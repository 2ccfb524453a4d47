"""Registry, player loaders and the SQL that derives the same tables."""

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapsewise import constants as K
from lapsewise.functions.numeric import round_even
from lapsewise.operators.clean import apply_winsor, fit_winsor
from lapsewise.operators.enrich import engineer_features
from lapsewise.operators.profile import player_profile
from lapsewise.plans.stages import enrich
from lapsewise.sources.tables import read_table
from lapsewise.sources.workspace import materialise

# Days without an order after which a customer of these tables counts as churned.
THRESHOLD = 180


@dataclass
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    def register(run):
        REGISTRY[name] = Query(run, sql)
        return run

    return register


# ---- Spark side -------------------------------------------------------------------------------

def players(spark: SparkSession, sf_dir: str, columns: list[str] | None = None) -> DataFrame:
    """Player table from the raw tables; only the feeders of the named columns are read."""
    customer, orders, lineitem = (read_table(spark, sf_dir, t) for t in ("customer", "orders", "lineitem"))
    return player_profile(customer, orders, lineitem, THRESHOLD, columns)


def stored_players(spark: SparkSession, sf_dir: str, columns: list[str] | None = None) -> DataFrame:
    """The same, written once, for operators that read it more than once."""
    return materialise(players(spark, sf_dir, columns), "players")


def winsorised(spark: SparkSession, sf_dir: str, columns: list[str] | None = None) -> DataFrame:
    rows = stored_players(spark, sf_dir, columns)
    return apply_winsor(rows, fit_winsor(rows, [c for c in K.NUMERIC_FEATURES if c in rows.columns]))


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich(players(spark, sf_dir))


def featured(spark: SparkSession, sf_dir: str) -> DataFrame:
    return engineer_features(enriched(spark, sf_dir))


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    """Fixed digits on the columns whose last bits depend on summation order."""
    return df.select([round_even(F.col(f"`{c}`"), digits).alias(c) if c in columns else F.col(f"`{c}`") for c in df.columns])


# ---- SQL side ---------------------------------------------------------------------------------

def r(expression: str, digits: int) -> str:
    """Half-even rounding on the scaled double."""
    return f"(round_even(CAST({expression} AS DOUBLE) * 1e{digits}, 0) / 1e{digits})"


def masked(column: str, remainder: int) -> str:
    return f"CASE WHEN a.o_custkey % 50 <> {remainder} THEN {column} END"


PLAYERS = f"""
act AS (
  SELECT o_custkey, count(*) AS session_count, min(o_orderdate) AS first_seen, max(o_orderdate) AS last_seen,
         sum(CASE WHEN o_orderpriority = '1-URGENT' THEN CAST(round_even(o_totalprice * 1e2, 0) AS BIGINT) ELSE 0 END) AS cents
  FROM orders GROUP BY o_custkey),
seq AS (
  SELECT o_custkey, coalesce(o_orderstatus = 'F', false) AS lost,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
  FROM orders),
streaks AS (
  SELECT o_custkey, coalesce(min(CASE WHEN NOT lost THEN rn END) - 1, count(*)) AS streak FROM seq GROUP BY o_custkey),
items AS (
  SELECT o_custkey, sum(l_quantity) AS quantity, avg(CASE WHEN l_returnflag <> 'R' THEN 1 ELSE 0 END) AS won,
         count(DISTINCT l_suppkey) AS suppliers, count(DISTINCT l_partkey) AS parts
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_custkey),
p AS (
  SELECT a.o_custkey AS custkey,
         printf('P%06d', a.o_custkey) AS player_id,
         a.session_count AS session_count,
         {masked(r("coalesce(quantity, 0e0) / a.session_count", 1), 7)} AS avg_session_duration,
         CAST(datediff('day', CAST(last_seen AS DATE), CAST((SELECT max(o_orderdate) FROM orders) AS DATE)) AS BIGINT) AS last_login_days_ago,
         {r("coalesce(quantity, 0e0) / 60e0", 2)} AS total_playtime_hours,
         {masked(r("won", 3), 17)} AS win_rate,
         {masked(r("CAST(cents AS DOUBLE) / 1e6", 2), 27)} AS total_spend_usd,
         {masked("CAST(floor(coalesce(suppliers, 0) / 4e0) AS BIGINT)", 37)} AS friend_count,
         CASE c_mktsegment WHEN 'BUILDING' THEN 'PvP' WHEN 'AUTOMOBILE' THEN 'PvP' WHEN 'MACHINERY' THEN 'PvE'
              WHEN 'FURNITURE' THEN 'Co-op' WHEN 'HOUSEHOLD' THEN 'Solo' END AS game_mode_primary,
         CAST(coalesce(parts, 0) AS BIGINT) AS achievement_count,
         CAST(coalesce(streak, 0) AS BIGINT) AS consecutive_losses,
         CAST(datediff('day', CAST(last_seen AS DATE), CAST((SELECT max(o_orderdate) FROM orders) AS DATE)) > {THRESHOLD} AS INTEGER) AS churn_label,
         CAST(first_seen AS DATE) AS join_date
  FROM act a JOIN customer ON c_custkey = a.o_custkey
  LEFT JOIN streaks s ON s.o_custkey = a.o_custkey LEFT JOIN items i ON i.o_custkey = a.o_custkey)"""

_LIMITS = ", ".join(
    f"quantile_cont(CAST({c} AS DOUBLE), 0.01) AS {c}_lo, quantile_cont(CAST({c} AS DOUBLE), 0.99) AS {c}_hi"
    for c in K.NUMERIC_FEATURES
)
_CLIPPED = ", ".join(
    f"CASE WHEN {c} IS NULL THEN NULL WHEN {c}_lo = {c}_hi THEN CAST({c} AS DOUBLE) "
    f"ELSE least(greatest(CAST({c} AS DOUBLE), {c}_lo), {c}_hi) END AS {c}"
    for c in K.NUMERIC_FEATURES
)
WINSORISED = f"""{PLAYERS},
lim AS (SELECT {_LIMITS} FROM p),
w AS (SELECT custkey, player_id, game_mode_primary, churn_label, join_date, {_CLIPPED} FROM p, lim)"""


def rank_pct(column: str) -> str:
    return (
        f"CASE WHEN {column} IS NOT NULL THEN (CAST(rank() OVER (ORDER BY {column} NULLS LAST) AS DOUBLE) "
        f"+ (count(*) OVER (PARTITION BY {column}) - 1) / 2e0) / count({column}) OVER () END"
    )


_RANK_SUM = " + ".join(f"{rank_pct(c)} * 1e2" for c in ("rfm_recency", "rfm_frequency", "rfm_monetary"))
ENRICHED = f"""{WINSORISED},
parts3 AS (
  SELECT *, (SELECT max(last_login_days_ago) FROM w) + 1e0 - last_login_days_ago AS rfm_recency,
         session_count AS rfm_frequency, ln(1e0 + coalesce(total_spend_usd, 0e0)) AS rfm_monetary FROM w),
e AS (SELECT *, {r(f"({_RANK_SUM}) / 3e0", 2)} AS rfm_score FROM parts3)"""


def feature_sql(source: str) -> str:
    """Select list of the nine features over a table."""
    spend, sessions = "coalesce(total_spend_usd, 0e0)", "greatest(CAST(session_count AS DOUBLE), 1e0)"
    friends = "CAST(coalesce(friend_count, 0) AS DOUBLE)"
    days = "CAST(last_login_days_ago AS DOUBLE)"
    engagement = (
        f"((1e0 - least(greatest({days}, 0e0), 180e0) / 180e0) * 0.40::DOUBLE"
        " + least(greatest(CAST(session_count AS DOUBLE), 0e0), 500e0) / 500e0 * 0.25::DOUBLE"
        " + least(greatest(coalesce(avg_session_duration, 45e0), 5e0), 240e0) / 240e0 * 0.20::DOUBLE"
        f" + least(greatest({friends}, 0e0), 50e0) / 50e0 * 0.15::DOUBLE) * 1e2"
    )
    velocity = "least(achievement_count / greatest(CAST(total_playtime_hours AS DOUBLE), 5e-1), 50e0)"
    tier = (
        f"CASE WHEN {spend} <= -1e-2 THEN NULL WHEN {spend} <= 0 THEN 0 WHEN {spend} <= 20 THEN 1 "
        f"WHEN {spend} <= 100 THEN 2 ELSE 3 END"
    )
    return f"""SELECT *,
  {r(f"{spend} / {sessions}", 4)} AS spend_per_session,
  {r(f"CAST(session_count AS DOUBLE) / greatest({days}, 7e0) * 7e0", 2)} AS rolling_avg_sessions_7d,
  {r("coalesce(win_rate, 5e-1) - CAST(coalesce(consecutive_losses, 0) AS DOUBLE) / 15e0 * 5e-1", 4)} AS win_rate_trend,
  {r(engagement, 2)} AS engagement_score,
  {r("1e0 / (exp(-((CAST(consecutive_losses AS DOUBLE) - 4e0) / 2e0)) + 1e0)", 4)} AS loss_streak_risk,
  {tier} AS monetisation_tier,
  {r(velocity, 4)} AS achievement_velocity,
  {r(f"{friends} / {sessions}", 4)} AS social_engagement_ratio,
  {r(f"{spend} * (1e0 / ({days} + 1e0))", 4)} AS spend_recency_interaction
  FROM {source}"""


FEATURED = f"{ENRICHED},\nf AS ({feature_sql('e')})"


def with_(ctes: str, body: str) -> str:
    return f"WITH {ctes.strip()}\n{body}"
