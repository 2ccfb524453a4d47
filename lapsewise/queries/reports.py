"""Exploratory and dashboard reports."""

from lapsewise import constants as K
from lapsewise.operators import aggregates as A
from lapsewise.operators.clean import with_display_columns
from lapsewise.queries.base import PLAYERS, WINSORISED, players, query, r, rounded, stored_players, winsorised, with_

SPEND0 = "coalesce(total_spend_usd, 0e0)"
CHURN = "avg(CAST(churn_label AS DOUBLE))"


@query(
    "churn_overview",
    with_(PLAYERS, f"""SELECT count(*) FILTER (WHERE churn_label = 0) AS active, count(*) FILTER (WHERE churn_label = 1) AS churned,
      {r(f"{CHURN} * 1e2", 1)} AS churn_rate_pct FROM p"""),
)
def churn_overview(spark, sf_dir):
    return A.churn_overview(players(spark, sf_dir, ["churn_label"]))


@query(
    "kpi_row",
    with_(WINSORISED, f"""SELECT count(*) AS total_players, CAST(sum(churn_label) AS BIGINT) AS churned_players,
      {r("sum(churn_label) / count(*) * 1e2", 1)} AS churn_rate_pct, {r(f"avg({SPEND0})", 2)} AS avg_spend,
      {r("avg(session_count)", 0)} AS avg_sessions FROM w"""),
)
def kpi_row(spark, sf_dir):
    return A.kpi_row(winsorised(spark, sf_dir, ["churn_label", "total_spend_usd", "session_count"]))


@query(
    "kpi_row_empty",
    """SELECT CAST(0 AS BIGINT) AS total_players, CAST(0 AS BIGINT) AS churned_players, 0e0 AS churn_rate_pct,
       CAST(NULL AS DOUBLE) AS avg_spend, CAST(NULL AS DOUBLE) AS avg_sessions""",
)
def kpi_row_empty(spark, sf_dir):
    df = players(spark, sf_dir, ["churn_label", "total_spend_usd", "session_count"])
    return A.kpi_row(df.where("session_count < 0"))


_MODE = f"""SELECT game_mode_primary AS game_mode, {r(CHURN, 6)} AS churn_rate, count(churn_label) AS player_count,
  {r(f"{CHURN} * 1e2", 1)} AS churn_pct"""


@query("churn_by_mode", with_(PLAYERS, f"{_MODE} FROM p WHERE game_mode_primary IS NOT NULL GROUP BY 1"))
def churn_by_mode(spark, sf_dir):
    return rounded(A.churn_by_mode(players(spark, sf_dir, [K.MODE, "churn_label"])), 6, "churn_rate")


@query(
    "churn_by_mode_vs_overall",
    with_(PLAYERS, f"""{_MODE}, {r(f"(SELECT {CHURN} FROM p)", 6)} AS overall_rate, {CHURN} > (SELECT {CHURN} FROM p) AS above_overall
      FROM p WHERE game_mode_primary IS NOT NULL GROUP BY 1"""),
)
def churn_by_mode_vs_overall(spark, sf_dir):
    df = stored_players(spark, sf_dir, [K.MODE, "churn_label"])
    return rounded(A.churn_by_mode_vs_overall(df), 6, "churn_rate", "overall_rate")


_TIER = f"CASE WHEN {SPEND0} <= -1e0 THEN NULL WHEN {SPEND0} <= 0 THEN 'Free' WHEN {SPEND0} <= 20 THEN 'Minnow' WHEN {SPEND0} <= 100 THEN 'Dolphin' ELSE 'Whale' END"


@query("spend_tier_counts", with_(WINSORISED, f"SELECT {_TIER} AS tier, count(*) AS players FROM w GROUP BY 1"))
def spend_tier_counts(spark, sf_dir):
    return A.spend_tier_counts(with_display_columns(winsorised(spark, sf_dir, ["churn_label", "total_spend_usd"])))


@query("spend_tier_labels", with_(WINSORISED, f"SELECT player_id, {_TIER} AS spend_tier_label FROM w"))
def spend_tier_labels(spark, sf_dir):
    df = winsorised(spark, sf_dir, ["player_id", "churn_label", "total_spend_usd"])
    return with_display_columns(df).select("player_id", "spend_tier_label")


_STATUS = "CASE WHEN churn_label = 0 THEN 'Active' WHEN churn_label = 1 THEN 'Churned' END"


@query(
    "kpi_cube",
    with_(WINSORISED, f"""SELECT game_mode_primary AS game_mode, {_TIER} AS spend_tier, {_STATUS} AS status,
      CAST(grouping(game_mode_primary) * 4 + grouping({_TIER}) * 2 + grouping({_STATUS}) AS BIGINT) AS level,
      count(*) AS players, count(churn_label) AS labelled, CAST(sum(churn_label) AS BIGINT) AS churned, {r(f"sum({SPEND0})", 2)} AS spend,
      {r("sum(session_count)", 2)} AS sessions, count(session_count) AS with_sessions
      FROM w GROUP BY CUBE (game_mode_primary, {_TIER}, {_STATUS})"""),
)
def kpi_cube(spark, sf_dir):
    df = winsorised(spark, sf_dir, [K.MODE, "churn_label", "total_spend_usd", "session_count"])
    return rounded(A.kpi_cube(with_display_columns(df)), 2, "spend", "sessions")


def _histogram_sql(x: str, bins: int, shared: bool = False, table: str = "p") -> str:
    """CTEs ending in h(label, lo, hi, bin, n, total)."""
    span = "(SELECT min(x) AS lo, max(x) AS hi FROM hx)" if shared else "(SELECT label AS l2, min(x) AS lo, max(x) AS hi FROM hx GROUP BY 1)"
    match = "" if shared else "WHERE hx.label = l2"
    return f"""hx AS (SELECT churn_label AS label, CAST({x} AS DOUBLE) AS x FROM {table} WHERE {x} IS NOT NULL),
  hp AS (SELECT label, lo, hi, CAST(least(CASE WHEN (hi - lo) / {bins}e0 > 0 THEN floor((x - lo) / ((hi - lo) / {bins}e0)) ELSE 0 END, {bins - 1}) AS BIGINT) AS bin
         FROM hx, {span} {match}),
  h AS (SELECT label, lo, hi, bin, count(*) AS n, (SELECT count(*) FROM hx b WHERE b.label = hp.label) AS total FROM hp GROUP BY label, lo, hi, bin)"""


def _histogram_cells(bins: int) -> str:
    w = f"((hi - lo) / {bins}e0)"
    return f"label, bin, {r(f'lo + bin * {w}', 6)} AS low, {r(f'lo + (bin + 1) * {w}', 6)} AS high, n"


def _density(bins: int) -> str:
    return r(f"CASE WHEN hi > lo THEN n / (total * ((hi - lo) / {bins}e0)) END", 6) + " AS density"


@query(
    "recency_histogram",
    with_(f"{PLAYERS},\n{_histogram_sql('last_login_days_ago', 50)}",
          f"""SELECT {_histogram_cells(50)}, (SELECT quantile_cont(CAST(last_login_days_ago AS DOUBLE), 0.5) FROM p WHERE churn_label = h.label) AS median FROM h"""),
)
def recency_histogram(spark, sf_dir):
    return rounded(A.recency_histogram(stored_players(spark, sf_dir, ["churn_label", "last_login_days_ago"])), 6, "low", "high")


@query(
    "recency_overlay",
    with_(f"{WINSORISED},\n{_histogram_sql('last_login_days_ago', 60, True, 'w')}", f"SELECT {_histogram_cells(60)} FROM h"),
)
def recency_overlay(spark, sf_dir):
    return rounded(A.recency_overlay(winsorised(spark, sf_dir, ["churn_label", "last_login_days_ago"])), 6, "low", "high")


@query(
    "session_density",
    with_(f"{PLAYERS},\n{_histogram_sql('least(session_count, 200)', 60)}", f"SELECT {_histogram_cells(60)}, {_density(60)} FROM h"),
)
def session_density(spark, sf_dir):
    return rounded(A.session_density(stored_players(spark, sf_dir, ["churn_label", "session_count"])), 6, "low", "high", "density")


_LONG = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, churn_label AS label, least(CAST({c} AS DOUBLE), (SELECT quantile_cont(CAST({c} AS DOUBLE), 0.98) FROM p)) AS x "
    f"FROM p WHERE {c} IS NOT NULL" for c in K.NUMERIC_FEATURES
)


@query(
    "box_stats",
    with_(f"""{PLAYERS},
  lg AS ({_LONG}),
  bx AS (SELECT feature AS f2, label AS l2, quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.5) AS median, quantile_cont(x, 0.75) AS q3 FROM lg GROUP BY 1, 2),
  j AS (SELECT *, x >= q1 - (q3 - q1) * 1.5::DOUBLE AND x <= q3 + (q3 - q1) * 1.5::DOUBLE AS inside FROM lg JOIN bx ON feature = f2 AND label = l2)""",
          f"""SELECT feature, label, {r("q1", 6)} AS q1, {r("median", 6)} AS median, {r("q3", 6)} AS q3,
      {r("min(CASE WHEN inside THEN x END)", 6)} AS whisker_low, {r("max(CASE WHEN inside THEN x END)", 6)} AS whisker_high,
      count(*) AS n, count(*) FILTER (WHERE NOT inside) AS outliers FROM j GROUP BY feature, label, q1, median, q3"""),
)
def box_stats(spark, sf_dir):
    return rounded(A.box_stats(stored_players(spark, sf_dir)), 6, "q1", "median", "q3", "whisker_low", "whisker_high")


_WIN = f"""{PLAYERS},
  wr AS (SELECT churn_label, win_rate, coalesce(win_rate, (SELECT quantile_cont(win_rate, 0.5) FROM p)) AS x FROM p),
  wb AS (SELECT churn_label, win_rate, CAST(least(greatest(ceil((x - lo) / ((hi - lo) / 10e0)) - 1, 0), 9) AS BIGINT) AS win_rate_bin
         FROM wr, (SELECT min(x) AS lo, max(x) AS hi FROM wr)),
  wc AS (SELECT win_rate_bin, {CHURN} AS churn_rate, count(*) AS n, avg(win_rate) AS avg_win_rate FROM wb GROUP BY 1)"""


@query("churn_by_win_rate", with_(_WIN, f"SELECT win_rate_bin, {r('churn_rate', 6)} AS churn_rate, n, {r('avg_win_rate', 6)} AS avg_win_rate FROM wc"))
def churn_by_win_rate(spark, sf_dir):
    return rounded(A.churn_by_win_rate(stored_players(spark, sf_dir, ["churn_label", "win_rate"])), 6, "churn_rate", "avg_win_rate")


def _det(a, b, c, d, e, f, g, h, i):
    return f"({a} * ({e} * {i} - {f} * {h}) - {b} * ({d} * {i} - {f} * {g}) + {c} * ({d} * {h} - {e} * {g}))"


_BASE = _det("s4", "s3", "s2", "s3", "s2", "s1", "s2", "s1", "s0")


@query(
    "win_rate_trend_line",
    with_(f"""{_WIN},
  cx AS (SELECT avg_win_rate - (SELECT avg(avg_win_rate) FROM wc) AS x, (SELECT avg(avg_win_rate) FROM wc) AS m, churn_rate * 1e2 AS y FROM wc WHERE avg_win_rate IS NOT NULL),
  ps AS (SELECT max(m) AS m, CAST(count(*) AS DOUBLE) AS s0, sum(x) AS s1, sum(x * x) AS s2, sum(x * x * x) AS s3, sum(x * x * x * x) AS s4,
         sum(y) AS t0, sum(x * y) AS t1, sum(x * x * y) AS t2 FROM cx),
  so AS (SELECT m, {_det("t2", "s3", "s2", "t1", "s2", "s1", "t0", "s1", "s0")} / {_BASE} AS a,
         {_det("s4", "t2", "s2", "s3", "t1", "s1", "s2", "t0", "s0")} / {_BASE} AS b,
         {_det("s4", "s3", "t2", "s3", "s2", "t1", "s2", "s1", "t0")} / {_BASE} AS c FROM ps)""",
          f"SELECT {r('a', 4)} AS a2, {r('b - 2e0 * a * m', 4)} AS a1, {r('a * m * m - b * m + c', 4)} AS a0 FROM so"),
)
def win_rate_trend_line(spark, sf_dir):
    return rounded(A.win_rate_trend_line(stored_players(spark, sf_dir, ["churn_label", "win_rate"])), 4, "a2", "a1", "a0")


_LOGGED = f"ln(1e0 + {SPEND0})"


@query(
    "log_spend_summary",
    with_(PLAYERS, f"""SELECT churn_label AS label, count(*) AS n, {r(f"min({_LOGGED})", 6)} AS low,
      {r(f"quantile_cont({_LOGGED}, 0.5)", 6)} AS median, {r(f"max({_LOGGED})", 6)} AS high FROM p GROUP BY 1"""),
)
def log_spend_summary(spark, sf_dir):
    return rounded(A.log_spend_summary(stored_players(spark, sf_dir, ["churn_label", "total_spend_usd"])), 6, "low", "median", "high")


@query(
    "log_spend_density",
    with_(f"{PLAYERS},\n{_histogram_sql(_LOGGED, 50)}", f"SELECT {_histogram_cells(50)}, {_density(50)} FROM h"),
)
def log_spend_density(spark, sf_dir):
    return rounded(A.log_spend_density(stored_players(spark, sf_dir, ["churn_label", "total_spend_usd"])), 6, "low", "high", "density")


# written out, with an open end, so that the SQL doesn't share the operator's edges
_LOSSES = {
    "0": "consecutive_losses = 0", "1-2": "consecutive_losses BETWEEN 1 AND 2", "3-4": "consecutive_losses BETWEEN 3 AND 4",
    "5-6": "consecutive_losses BETWEEN 5 AND 6", "7-10": "consecutive_losses BETWEEN 7 AND 10", "11+": "consecutive_losses >= 11",
}
_FRIENDS = {"0": (0, 0), "1-2": (1, 2), "3-5": (3, 5), "6-10": (6, 10), "11-20": (11, 20), "21-50": (21, 50), "50+": (51, "9e18")}


@query(
    "churn_mode_by_losses",
    with_(PLAYERS, "SELECT game_mode_primary AS game_mode, " + ", ".join(
        f"""{r(f"avg(CASE WHEN {rule} THEN CAST(churn_label AS DOUBLE) END) * 1e2", 6)} AS "{name}" """
        for name, rule in _LOSSES.items()
    ) + "FROM p WHERE game_mode_primary IS NOT NULL GROUP BY 1"),
)
def churn_mode_by_losses(spark, sf_dir):
    df = players(spark, sf_dir, [K.MODE, "churn_label", "consecutive_losses"])
    return rounded(A.churn_mode_by_losses(df), 6, *_LOSSES)


_FRIEND_ROWS = " UNION ALL ".join(f"SELECT '{name}' AS friend_bin, {lo} AS lo, {hi} AS hi" for name, (lo, hi) in _FRIENDS.items())


@query(
    "churn_by_friends",
    with_(PLAYERS, f"""SELECT friend_bin, {r(CHURN, 6)} AS churn_rate, count(churn_label) AS n, {r(f"{CHURN} * 1e2", 6)} AS churn_pct
      FROM ({_FRIEND_ROWS}) b LEFT JOIN p ON coalesce(friend_count, 0) BETWEEN lo AND hi GROUP BY 1"""),
)
def churn_by_friends(spark, sf_dir):
    return rounded(A.churn_by_friends(players(spark, sf_dir, ["churn_label", "friend_count"])), 6, "churn_rate", "churn_pct")


_CORR_COLUMNS = K.NUMERIC_FEATURES + [K.LABEL]
_CORR = " UNION ALL ".join(
    f"SELECT '{_CORR_COLUMNS[i]}' AS row_feature, '{_CORR_COLUMNS[j]}' AS col_feature, "
    f"{r(f'corr(CAST({_CORR_COLUMNS[i]} AS DOUBLE), CAST({_CORR_COLUMNS[j]} AS DOUBLE))', 6)} AS corr FROM p"
    for i in range(len(_CORR_COLUMNS)) for j in range(i)
)


@query("correlation_matrix", with_(PLAYERS, _CORR))
def correlation_matrix(spark, sf_dir):
    return rounded(A.correlation_pairs(players(spark, sf_dir), _CORR_COLUMNS), 6, "corr")


@query(
    "top_churn_correlations",
    with_(f"{PLAYERS},\ncm AS ({_CORR})", "SELECT col_feature AS feature, abs(corr) AS abs_corr FROM cm WHERE row_feature = 'churn_label' ORDER BY 2 DESC, 1 LIMIT 5"),
)
def top_churn_correlations(spark, sf_dir):
    return rounded(A.top_churn_correlations(players(spark, sf_dir)), 6, "abs_corr")


@query(
    "cohort_retention",
    with_(PLAYERS, f"""SELECT strftime(join_date, '%Y-%m') AS join_month, count(*) AS total, count(*) FILTER (WHERE churn_label = 0) AS retained,
      {r("count(*) FILTER (WHERE churn_label = 0) / count(*) * 1e2", 1)} AS retention_rate FROM p GROUP BY 1"""),
)
def cohort_retention(spark, sf_dir):
    return A.cohort_retention(players(spark, sf_dir, ["join_date", "churn_label"]))


_STAGES = [
    ("All Players", "true"),
    ("5+ Sessions", "session_count >= 5"),
    ("10+ Achievements", "achievement_count >= 10"),
    ("First Purchase", f"{SPEND0} > 0"),
    ("Spent $10+", f"{SPEND0} >= 10"),
]


@query("engagement_funnel", with_(PLAYERS, " UNION ALL ".join(
    f"SELECT '{name}' AS stage, count(*) FILTER (WHERE {rule}) AS players, {r(f'count(*) FILTER (WHERE {rule}) / count(*) * 1e2', 1)} AS pct FROM p"
    for name, rule in _STAGES
)))
def engagement_funnel(spark, sf_dir):
    return A.engagement_funnel(players(spark, sf_dir, ["session_count", "achievement_count", "total_spend_usd"]))


@query(
    "spend_by_mode_and_status",
    with_(PLAYERS, f"""SELECT game_mode_primary AS game_mode, {r("avg(CASE WHEN churn_label = 0 THEN total_spend_usd END)", 6)} AS "Active",
      {r("avg(CASE WHEN churn_label = 1 THEN total_spend_usd END)", 6)} AS "Churned" FROM p WHERE game_mode_primary IS NOT NULL GROUP BY 1"""),
)
def spend_by_mode_and_status(spark, sf_dir):
    df = players(spark, sf_dir, [K.MODE, "churn_label", "total_spend_usd"])
    return rounded(A.spend_by_mode_and_status(df), 6, "Active", "Churned")
