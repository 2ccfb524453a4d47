"""Cleaning, RFM, features, ranks, split and preprocessing."""

from pyspark.sql import functions as F

from lapsewise import constants as K
from lapsewise.functions.features import FILL
from lapsewise.functions.numeric import round_even
from lapsewise.operators import clean as C
from lapsewise.operators import ranks as X
from lapsewise.operators import split as S
from lapsewise.operators.enrich import engineer_features, rfm_parts, spend_quality, summarise_features
from lapsewise.plans.stages import split_matrices
from lapsewise.queries.base import (
    ENRICHED,
    FEATURED,
    PLAYERS,
    WINSORISED,
    enriched,
    feature_sql,
    featured,
    players,
    query,
    r,
    rank_pct,
    rounded,
    stored_players,
    winsorised,
    with_,
)
from lapsewise.queries.tables import SPLIT_SQL
from lapsewise.sources.sinks import EXPORT_COLUMNS
from lapsewise.sources.tables import read_table
from lapsewise.sources.workspace import materialise

N = K.NUMERIC_FEATURES


@query(
    "remove_duplicates",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM (
         SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS rn FROM lineitem)
       WHERE rn = 1""",
)
def remove_duplicates(spark, sf_dir):
    rows = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    order = rows.withColumn("_order", F.struct("l_linenumber", "l_partkey", "l_suppkey"))
    return C.remove_duplicates(order, "l_orderkey", "_order").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")


@query(
    "remove_duplicates_null_order",
    """SELECT l_orderkey, seq, l_partkey, l_quantity FROM (
         SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY seq NULLS LAST, l_partkey, l_quantity) AS rn
         FROM (SELECT l_orderkey, CASE WHEN l_linenumber % 2 = 0 THEN l_linenumber END AS seq, l_partkey, l_quantity FROM lineitem))
       WHERE rn = 1""",
)
def remove_duplicates_null_order(spark, sf_dir):
    """Orders of one line have no order value at all; every other line of the rest has none."""
    rows = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", F.when(F.col("l_linenumber") % 2 == 0, F.col("l_linenumber")).alias("seq"), "l_partkey", "l_quantity"
    )
    return C.remove_duplicates(rows, "l_orderkey", "seq")


@query(
    "duplicate_count",
    'SELECT count(*) AS "rows", count(DISTINCT l_orderkey) AS kept, count(*) - count(DISTINCT l_orderkey) AS removed FROM lineitem',
)
def duplicate_count(spark, sf_dir):
    return C.duplicate_count(read_table(spark, sf_dir, "lineitem"), "l_orderkey")


@query("winsorise", with_(WINSORISED, "SELECT player_id, " + ", ".join(f"{r(c, 6)} AS {c}" for c in N) + " FROM w"))
def winsorise(spark, sf_dir):
    return winsorised(spark, sf_dir).select("player_id", *[round_even(F.col(c), 6).alias(c) for c in N])


@query(
    "winsor_report",
    with_(WINSORISED, " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {r(f'max({c}_lo)', 6)} AS low, {r(f'max({c}_hi)', 6)} AS high, "
        f"count(*) FILTER (WHERE {c} < {c}_lo OR {c} > {c}_hi) AS clipped FROM p, lim HAVING max({c}_lo) <> max({c}_hi)"
        for c in N
    )),
)
def winsor_report(spark, sf_dir):
    df = stored_players(spark, sf_dir)
    return rounded(C.winsor_report(df, C.fit_winsor(df, N)), 6, "low", "high")


@query(
    "null_profile",
    with_(PLAYERS, " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) AS nulls FROM p WHERE {c} IS NULL HAVING count(*) > 0" for c in ["player_id", *N, K.MODE, K.LABEL]
    )),
)
def null_profile(spark, sf_dir):
    return C.null_profile(players(spark, sf_dir).drop("join_date"))


@query(
    "fill_constants",
    with_(PLAYERS, """SELECT player_id, coalesce(total_spend_usd, 0e0) AS total_spend_usd, coalesce(avg_session_duration, 45e0) AS avg_session_duration,
      coalesce(win_rate, 5e-1) AS win_rate, CAST(coalesce(consecutive_losses, 0) AS DOUBLE) AS consecutive_losses,
      CAST(coalesce(friend_count, 0) AS DOUBLE) AS friend_count FROM p"""),
)
def fill_constants(spark, sf_dir):
    return C.fill_constants(players(spark, sf_dir).select("player_id", *FILL), FILL)


@query(
    "impute_median",
    with_(PLAYERS, "SELECT player_id, " + ", ".join(
        f"{r(f'coalesce(CAST({c} AS DOUBLE), (SELECT quantile_cont(CAST({c} AS DOUBLE), 0.5) FROM p))', 6)} AS {c}" for c in N
    ) + " FROM p"),
)
def impute_median(spark, sf_dir):
    return rounded(C.impute_median(stored_players(spark, sf_dir).select("player_id", *N), N), 6, *N)


_MASKED_MODE = "(SELECT custkey, player_id, CASE WHEN custkey % 10 <> 3 THEN game_mode_primary END AS game_mode_primary FROM p)"


@query(
    "impute_mode",
    with_(PLAYERS, f"""SELECT player_id, coalesce(game_mode_primary, (SELECT game_mode_primary FROM {_MASKED_MODE}
      WHERE game_mode_primary IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, game_mode_primary LIMIT 1)) AS game_mode_primary FROM {_MASKED_MODE}"""),
)
def impute_mode(spark, sf_dir):
    df = stored_players(spark, sf_dir, ["player_id", K.MODE])
    number = F.substring("player_id", 2, 20).cast("bigint")
    return C.impute_mode(df.withColumn(K.MODE, F.when(number % 10 != 3, F.col(K.MODE))), K.MODE)


@query(
    "standard_scale",
    with_(PLAYERS, "SELECT player_id, " + ", ".join(
        f"{r(f'(CAST({c} AS DOUBLE) - avg({c}) OVER ()) / coalesce(nullif(stddev_pop({c}) OVER (), 0), 1e0)', 6)} AS {c}" for c in N
    ) + " FROM p"),
)
def standard_scale(spark, sf_dir):
    return rounded(C.standard_scale(stored_players(spark, sf_dir).select("player_id", *N), N), 6, *N)


@query(
    "one_hot",
    with_(PLAYERS, "SELECT player_id, " + ", ".join(
        f"CASE WHEN game_mode_primary = '{m}' THEN 1e0 ELSE 0e0 END AS \"game_mode_primary_{m}\"" for m in ("PvE", "PvP", "Solo")
    ) + " FROM p"),
)
def one_hot(spark, sf_dir):
    df = stored_players(spark, sf_dir, ["player_id", K.MODE])
    return df.select("player_id", *C.one_hot(K.MODE, C.fit_categories(df, K.MODE)))


_M = K.NUMERIC_FEATURES + K.RFM_FEATURES
_PREP = f"""{ENRICHED},
  d AS (SELECT *, {SPLIT_SQL} AS split FROM e),
  md AS (SELECT {", ".join(f"quantile_cont(CAST({c} AS DOUBLE), 0.5) AS {c}_m" for c in _M)} FROM d WHERE split = 'train'),
  fi AS (SELECT player_id, split, churn_label, game_mode_primary, {", ".join(f"coalesce(CAST({c} AS DOUBLE), {c}_m) AS {c}" for c in _M)} FROM d, md),
  st AS (SELECT {", ".join(f"avg({c}) AS {c}_a, coalesce(nullif(stddev_pop({c}), 0), 1e0) AS {c}_s" for c in _M)} FROM fi WHERE split = 'train')"""
_PREP_CELLS = ", ".join(f"{r(f'({c} - {c}_a) / {c}_s', 5)} AS {c}" for c in _M) + ", " + ", ".join(
    f"CASE WHEN game_mode_primary = '{m}' THEN 1e0 ELSE 0e0 END AS \"game_mode_primary_{m}\"" for m in ("PvE", "PvP", "Solo")
)


@query("preprocess_matrix", with_(_PREP, f"SELECT player_id, split, churn_label, {_PREP_CELLS} FROM fi, st"))
def preprocess_matrix(spark, sf_dir):
    return rounded(split_matrices(enriched(spark, sf_dir)).table, 5, *_M)


@query(
    "project_available",
    with_(PLAYERS, "SELECT player_id, session_count, last_login_days_ago, total_spend_usd, win_rate, churn_label FROM p"),
)
def project_available(spark, sf_dir):
    return C.project(players(spark, sf_dir), EXPORT_COLUMNS)


@query("label_subset", with_(PLAYERS, "SELECT player_id, session_count FROM p WHERE churn_label = 1"))
def label_subset(spark, sf_dir):
    return players(spark, sf_dir, ["player_id", "session_count", "churn_label"]).where("churn_label = 1").drop("churn_label")


@query(
    "membership_filter",
    """SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""",
)
def membership_filter(spark, sf_dir):
    chosen = read_table(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    return C.membership(read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), chosen, "o_custkey")


# ---- RFM and features -------------------------------------------------------------------------

@query(
    "rfm_parts",
    with_(PLAYERS, f"""SELECT player_id, (SELECT max(last_login_days_ago) FROM p) + 1e0 - last_login_days_ago AS rfm_recency,
      CAST(session_count AS DOUBLE) AS rfm_frequency, {r("ln(1e0 + coalesce(total_spend_usd, 0e0))", 6)} AS rfm_monetary FROM p"""),
)
def rfm(spark, sf_dir):
    df = stored_players(spark, sf_dir, ["player_id", "last_login_days_ago", "session_count", "total_spend_usd"])
    return rounded(rfm_parts(df).select("player_id", *K.RFM_FEATURES[:3]), 6, "rfm_monetary")


@query("rfm_score", with_(ENRICHED, "SELECT player_id, rfm_recency, rfm_score FROM e"))
def rfm_score(spark, sf_dir):
    return enriched(spark, sf_dir).select("player_id", "rfm_recency", "rfm_score")


@query("engineer_features", with_(FEATURED, "SELECT player_id, " + ", ".join(K.ENGINEERED_FEATURES) + " FROM f"))
def features(spark, sf_dir):
    return featured(spark, sf_dir).select("player_id", *K.ENGINEERED_FEATURES)


@query(
    "engineer_features_raw",
    with_(f"{PLAYERS},\nf AS ({feature_sql('p')})", "SELECT player_id, " + ", ".join(K.ENGINEERED_FEATURES) + " FROM f"),
)
def features_raw(spark, sf_dir):
    return engineer_features(players(spark, sf_dir)).select("player_id", *K.ENGINEERED_FEATURES)


def _describe_sql(table: str, columns: list[str], digits: int) -> str:
    def part(c):
        x = f"CAST({c} AS DOUBLE)"
        cells = [("mean", f"avg({x})"), ("std", f"stddev_samp({x})"), ("min", f"min({x})"), ("p25", f"quantile_cont({x}, 0.25)"),
                 ("p50", f"quantile_cont({x}, 0.5)"), ("p75", f"quantile_cont({x}, 0.75)"), ("max", f"max({x})")]
        return f"SELECT '{c}' AS feature, count({c}) AS count, " + ", ".join(f"{r(e, digits)} AS {n}" for n, e in cells) + f" FROM {table}"

    return " UNION ALL ".join(part(c) for c in columns)


@query("summarise_features", with_(FEATURED, _describe_sql("f", K.ENGINEERED_FEATURES, 4)))
def summarise(spark, sf_dir):
    return rounded(summarise_features(materialise(featured(spark, sf_dir), "featured")), 4, "mean", "std", "min", "p25", "p50", "p75", "max")


@query("describe_numerics", with_(PLAYERS, _describe_sql("p", [*N, K.LABEL], 2)))
def describe_numerics(spark, sf_dir):
    return C.describe(stored_players(spark, sf_dir), [*N, K.LABEL], 2)


@query("spend_quality", with_(PLAYERS, "SELECT player_id, total_spend_usd - 30e0 AS total_spend_usd FROM p WHERE total_spend_usd - 30e0 <= -1e-2"))
def spend_quality_query(spark, sf_dir):
    df = players(spark, sf_dir, ["player_id", "total_spend_usd"])
    return spend_quality(df.withColumn("total_spend_usd", F.col("total_spend_usd") - 30.0))


# ---- ranks ------------------------------------------------------------------------------------

@query(
    "running_order_counts",
    f"""WITH g AS (SELECT o_totalprice AS value, count(*) AS n FROM orders GROUP BY 1)
        SELECT value, n, CAST(sum(n) OVER (ORDER BY value) AS BIGINT) AS cum_n, CAST(sum(n) OVER () AS BIGINT) AS total_n FROM g""",
)
def running_order_counts(spark, sf_dir):
    prices = read_table(spark, sf_dir, "orders").select(F.col("o_totalprice").alias("value"))
    return X.running_totals(X.collapse(prices, "value"), "value")


_QUANTILES = " UNION ALL ".join(
    f"SELECT o_orderstatus, 'o_totalprice' AS feature, CAST({q} AS DOUBLE) AS fraction, "
    f"{r(f'quantile_cont(o_totalprice, {q})', 4)} AS quantile FROM orders GROUP BY 1"
    for q in (0.0, 0.1, 0.99, 1.0)
)


@query("quantiles_by_status", _QUANTILES)
def quantiles_by_status(spark, sf_dir):
    orders = read_table(spark, sf_dir, "orders")
    return rounded(X.quantiles(orders, ["o_totalprice"], [0.0, 0.1, 0.99, 1.0], ["o_orderstatus"]), 4, "quantile")


@query(
    "rank_pct",
    with_(PLAYERS, f"SELECT player_id, {r(rank_pct('win_rate'), 9)} AS win_rate_pct, {r(rank_pct('session_count'), 9)} AS session_pct FROM p"),
)
def rank_pct_query(spark, sf_dir):
    df = stored_players(spark, sf_dir, ["player_id", "win_rate", "session_count"])
    ranked = X.with_rank_pct(df, {"win_rate": "win_rate_pct", "session_count": "session_pct"}, "player_id")
    return rounded(ranked.select("player_id", "win_rate_pct", "session_pct"), 9, "win_rate_pct", "session_pct")


@query(
    "spend_cdf",
    with_(PLAYERS, f"""SELECT DISTINCT coalesce(total_spend_usd, 0e0) AS value,
      {r("CAST(count(*) OVER (ORDER BY coalesce(total_spend_usd, 0e0)) AS DOUBLE) / count(*) OVER ()", 9)} AS cdf FROM p"""),
)
def spend_cdf(spark, sf_dir):
    return rounded(X.ecdf(players(spark, sf_dir, ["total_spend_usd"]), "total_spend_usd"), 9, "cdf")


@query(
    "revenue_pareto",
    with_(f"""{PLAYERS},
  g AS (SELECT coalesce(total_spend_usd, 0e0) AS value, count(*) AS n FROM p GROUP BY 1)""",
          f"""SELECT value, n, CAST(sum(n) OVER (ORDER BY value DESC) AS BIGINT) AS cum_n,
      {r("sum(n) OVER (ORDER BY value DESC) / sum(n) OVER () * 1e2", 6)} AS pct_players,
      {r("sum(n * value) OVER (ORDER BY value DESC) / sum(n * value) OVER ()", 6)} AS cum_share FROM g"""),
)
def revenue_pareto(spark, sf_dir):
    return rounded(X.pareto(players(spark, sf_dir, ["total_spend_usd"]), "total_spend_usd"), 6, "pct_players", "cum_share")


@query(
    "top_fifth_revenue",
    with_(f"""{PLAYERS},
  o AS (SELECT coalesce(total_spend_usd, 0e0) AS v, row_number() OVER (ORDER BY coalesce(total_spend_usd, 0e0) DESC, player_id) AS rn,
        count(*) OVER () AS n FROM p)""",
          f"""SELECT CAST(max(floor(n * 0.2::DOUBLE)) AS BIGINT) AS top_players,
      {r("sum(CASE WHEN rn <= floor(n * 0.2::DOUBLE) THEN v ELSE 0e0 END) / sum(v)", 6)} AS revenue_share FROM o"""),
)
def top_fifth_revenue(spark, sf_dir):
    return rounded(X.top_share(players(spark, sf_dir, ["total_spend_usd"]), "total_spend_usd"), 6, "revenue_share")


@query("player_preview", with_(PLAYERS, "SELECT player_id, session_count, total_spend_usd FROM p ORDER BY player_id LIMIT 100"))
def player_preview(spark, sf_dir):
    df = players(spark, sf_dir, ["player_id", "session_count", "total_spend_usd"])
    return X.top_n(df, [F.col("player_id")], 100)


@query("filter_values", with_(PLAYERS, "SELECT DISTINCT game_mode_primary FROM p WHERE game_mode_primary IS NOT NULL"))
def filter_values(spark, sf_dir):
    return X.distinct_values(players(spark, sf_dir, [K.MODE]), K.MODE)


@query("seeded_sample", with_(PLAYERS, "SELECT player_id, session_count FROM p ORDER BY md5(player_id || '#42'), player_id LIMIT 500"))
def seeded_sample(spark, sf_dir):
    return X.seeded_sample(players(spark, sf_dir, ["player_id", "session_count"]), "player_id", 500)


# ---- split ------------------------------------------------------------------------------------

@query("hash_split", with_(PLAYERS, f"SELECT player_id, {SPLIT_SQL} AS split FROM p"))
def hash_split(spark, sf_dir):
    return S.hash_split(players(spark, sf_dir, ["player_id"]))


_SHUFFLED = f"""{PLAYERS},
  sh AS (SELECT player_id, churn_label, row_number() OVER (PARTITION BY churn_label ORDER BY md5(player_id || '#42'), player_id) AS pos,
         count(*) OVER (PARTITION BY churn_label) AS n FROM p)"""


@query(
    "stratified_split",
    with_(_SHUFFLED, """SELECT player_id, churn_label, CASE WHEN pos <= round_even(n * 0.7::DOUBLE, 0) THEN 'train'
      WHEN pos <= round_even(n * (0.7::DOUBLE + 0.15::DOUBLE), 0) THEN 'val' ELSE 'test' END AS split FROM sh"""),
)
def stratified_split(spark, sf_dir):
    return S.exact_split(stored_players(spark, sf_dir, ["player_id", "churn_label"])).select("player_id", "churn_label", "split")


@query(
    "split_audit",
    with_(f"""{_SHUFFLED},
  ct AS (SELECT churn_label, CASE WHEN pos <= round_even(n * 0.7::DOUBLE, 0) THEN 'train'
      WHEN pos <= round_even(n * (0.7::DOUBLE + 0.15::DOUBLE), 0) THEN 'val' ELSE 'test' END AS split FROM sh)""",
          f"SELECT split, count(*) AS players, {r('avg(CAST(churn_label AS DOUBLE)) * 1e2', 6)} AS churn_pct FROM ct GROUP BY 1"),
)
def split_audit(spark, sf_dir):
    return rounded(S.split_audit(S.exact_split(stored_players(spark, sf_dir, ["player_id", "churn_label"]))), 6, "churn_pct")


@query("split_overlap", with_(PLAYERS, "SELECT player_id FROM p WHERE false"))
def split_overlap(spark, sf_dir):
    return S.split_overlap(S.exact_split(stored_players(spark, sf_dir, ["player_id", "churn_label"])))


@query("stratified_folds", with_(_SHUFFLED, "SELECT player_id, CAST((pos - 1) % 5 AS INTEGER) AS fold FROM sh"))
def stratified_folds(spark, sf_dir):
    return S.with_folds(stored_players(spark, sf_dir, ["player_id", "churn_label"])).select("player_id", "fold")


@query("class_distribution", with_(PLAYERS, "SELECT churn_label, count(*) AS players FROM p GROUP BY 1"))
def class_distribution(spark, sf_dir):
    return S.class_distribution(players(spark, sf_dir, ["churn_label"]))


@query(
    "class_weights",
    with_(f"{PLAYERS},\ng AS (SELECT churn_label, count(*) AS n FROM p GROUP BY 1)",
          f"SELECT churn_label, {r('(SELECT sum(n) FROM g) / ((SELECT count(*) FROM g) * n)', 9)} AS weight FROM g"),
)
def class_weights(spark, sf_dir):
    return rounded(S.class_weights(stored_players(spark, sf_dir, ["churn_label"])), 9, "weight")
