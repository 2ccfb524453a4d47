"""Segment queries.

Reports that need a segment per player use fixed rules here (``rule_segments``), so that SQL can
give the same rows; ``kmeans_*`` run the fitted clustering.
"""

from pyspark.sql import functions as F

from lapsewise import constants as K
from lapsewise.functions.labels import intervention_tier
from lapsewise.functions.numeric import round_even
from lapsewise.operators import aggregates as A
from lapsewise.operators import segment as S
from lapsewise.operators.joins import with_constant_map, with_lookup
from lapsewise.queries.base import FEATURED, featured, query, r, rounded, winsorised, with_
from lapsewise.sources.tables import read_table
from lapsewise.sources.workspace import materialise, new_path

RULE_SQL = """s AS (SELECT *, CASE WHEN total_spend_usd > 80 THEN 'Whales' WHEN last_login_days_ago > 300 THEN 'At-Risk'
    WHEN session_count >= 10 THEN 'Champions' ELSE 'Casual' END AS segment,
  CASE WHEN total_spend_usd > 80 THEN 1 WHEN last_login_days_ago > 300 THEN 3
    WHEN session_count >= 10 THEN 0 ELSE 2 END AS cluster_id FROM f)"""
SEGMENTED = f"{FEATURED},\n{RULE_SQL}"
_QUALITY_FEATURES = ["session_count", "last_login_days_ago", "engagement_score", "rfm_score"]


def rule_segments(df):
    """segment and cluster_id by fixed rules on spend, recency and sessions."""
    rules = [
        (F.col("total_spend_usd") > 80, "Whales", 1),
        (F.col("last_login_days_ago") > 300, "At-Risk", 3),
        (F.col("session_count") >= 10, "Champions", 0),
    ]
    name, number = F, F
    for rule, segment, cluster in rules:
        name, number = name.when(rule, F.lit(segment)), number.when(rule, F.lit(cluster))
    return df.select("*", name.otherwise(F.lit("Casual")).alias("segment"), number.otherwise(F.lit(2)).alias("cluster_id"))


def segmented(spark, sf_dir):
    return rule_segments(featured(spark, sf_dir))


_RULE_COLUMNS = ["player_id", "total_spend_usd", "last_login_days_ago", "session_count"]


def segmented_only(spark, sf_dir, *more):
    """Segments and the named columns: nothing is ranked, and only the feeders of these columns are read."""
    return rule_segments(winsorised(spark, sf_dir, [*_RULE_COLUMNS, *more]))


def strategy_case(column: str) -> str:
    def quoted(text):
        return "'" + text.replace("'", "''") + "'"

    arms = " ".join(f"WHEN {quoted(k)} THEN {quoted(v)}" for k, v in K.RETENTION_STRATEGIES.items())
    return f"CASE {column} {arms} END"


@query("segment_counts", with_(SEGMENTED, "SELECT segment, count(*) AS players FROM s GROUP BY 1"))
def segment_counts(spark, sf_dir):
    return A.segment_counts(segmented_only(spark, sf_dir))


_PROFILE_CELLS = ", ".join(
    f"{r(f'avg(CAST({c} AS DOUBLE))', 2)} AS {c}_mean, {r(f'quantile_cont(CAST({c} AS DOUBLE), 0.5)', 2)} AS {c}_median"
    for c in K.PROFILE_FEATURES
)
_PROFILE = f"""SELECT segment, {_PROFILE_CELLS}, count(*) AS player_count,
  {r("avg(CAST(churn_label AS DOUBLE)) * 1e2", 1)} AS churn_rate_pct, {strategy_case("segment")} AS retention_strategy
  FROM s GROUP BY segment"""


@query("segment_profile", with_(SEGMENTED, _PROFILE))
def segment_profile(spark, sf_dir):
    return A.segment_profile(materialise(segmented(spark, sf_dir), "segmented"))


@query(
    "churn_by_segment",
    with_(SEGMENTED, f"""SELECT segment, {r("avg(CAST(churn_label AS DOUBLE))", 6)} AS churn_rate,
      {r("avg(CAST(churn_label AS DOUBLE)) * 1e2", 1)} AS churn_pct FROM s GROUP BY 1"""),
)
def churn_by_segment(spark, sf_dir):
    return rounded(A.churn_by_segment(segmented_only(spark, sf_dir, "churn_label")), 6, "churn_rate")


@query(
    "segment_cards",
    with_(SEGMENTED, f"""SELECT d.segment AS segment, count(s.segment) AS players,
      {r("avg(CAST(churn_label AS DOUBLE)) * 1e2", 1)} AS churn_pct,
      {r("avg(CASE WHEN s.segment IS NOT NULL THEN coalesce(total_spend_usd, 0e0) END)", 0)} AS avg_spend
      FROM (VALUES ('Champions'), ('Whales'), ('Casual'), ('At-Risk')) d(segment) LEFT JOIN s ON s.segment = d.segment GROUP BY 1"""),
)
def segment_cards(spark, sf_dir):
    return A.segment_cards(segmented_only(spark, sf_dir, "churn_label"))


_RADAR = " UNION ALL ".join(
    f"SELECT segment, '{c.replace('_', ' ').title()}' AS metric, {r(f'{c}_mean / (max({c}_mean) OVER () + 1e-8)', 6)} AS value FROM prof"
    for c in K.RADAR_FEATURES
)


@query("segment_radar", with_(f"{SEGMENTED},\nprof AS ({_PROFILE})", _RADAR))
def segment_radar(spark, sf_dir):
    profile = materialise(A.segment_profile(materialise(segmented(spark, sf_dir), "segmented")), "profile")
    return rounded(A.segment_radar(profile), 6, "value")


@query("segment_strategy_lookup", with_(SEGMENTED, f"SELECT player_id, segment, {strategy_case('segment')} AS strategy FROM s"))
def segment_strategy_lookup(spark, sf_dir):
    df = segmented_only(spark, sf_dir).select("player_id", "segment")
    return with_constant_map(df, "segment", K.RETENTION_STRATEGIES, "strategy")


_CENTROIDS = f"""cen AS (SELECT cluster_id, avg(total_spend_usd) AS total_spend_usd, avg(last_login_days_ago) AS last_login_days_ago,
    avg(session_count) AS session_count FROM s GROUP BY 1),
  wh AS (SELECT cluster_id FROM cen ORDER BY total_spend_usd DESC, cluster_id LIMIT 1),
  ar AS (SELECT cluster_id FROM cen WHERE cluster_id NOT IN (SELECT cluster_id FROM wh) ORDER BY last_login_days_ago DESC, cluster_id LIMIT 1),
  ch AS (SELECT cluster_id FROM cen WHERE cluster_id NOT IN (SELECT cluster_id FROM wh UNION ALL SELECT cluster_id FROM ar)
         ORDER BY session_count DESC, cluster_id LIMIT 1),
  nm AS (SELECT cluster_id, CASE WHEN cluster_id IN (SELECT cluster_id FROM wh) THEN 'Whales'
           WHEN cluster_id IN (SELECT cluster_id FROM ar) THEN 'At-Risk'
           WHEN cluster_id IN (SELECT cluster_id FROM ch) THEN 'Champions' ELSE 'Casual' END AS segment FROM cen)"""


def _centroids(df):
    return materialise(
        df.groupBy("cluster_id").agg(*[F.avg(c).alias(c) for c in ("total_spend_usd", "last_login_days_ago", "session_count")]),
        "centroids",
    )


@query("cluster_names", with_(f"{SEGMENTED},\n{_CENTROIDS}", "SELECT cluster_id, segment FROM nm"))
def cluster_names(spark, sf_dir):
    return S.name_clusters(_centroids(segmented_only(spark, sf_dir)))


@query(
    "cluster_name_lookup",
    with_(f"{SEGMENTED},\n{_CENTROIDS}", "SELECT s.player_id AS player_id, nm.segment AS segment FROM s JOIN nm ON nm.cluster_id = s.cluster_id"),
)
def cluster_name_lookup(spark, sf_dir):
    df = materialise(segmented_only(spark, sf_dir), "segmented")
    return with_lookup(df.select("player_id", "cluster_id"), S.name_clusters(_centroids(df)), "cluster_id").select("player_id", "segment")


_DIST = "sqrt(" + " + ".join(f"pow({{a}}.{c} - {{b}}.{c}, 2)" for c in _QUALITY_FEATURES) + ")"


@query(
    "davies_bouldin",
    with_(
        f"""{SEGMENTED},
  cen AS (SELECT cluster_id, {", ".join(f"avg({c}) AS {c}" for c in _QUALITY_FEATURES)} FROM s GROUP BY 1),
  spread AS (SELECT s.cluster_id AS cluster_id, avg({_DIST.format(a="s", b="cen")}) AS d FROM s JOIN cen ON cen.cluster_id = s.cluster_id GROUP BY 1),
  cs AS (SELECT cen.*, d FROM cen JOIN spread ON cen.cluster_id = spread.cluster_id),
  worst AS (SELECT a.cluster_id AS cluster_id, max((a.d + b.d) / {_DIST.format(a="a", b="b")}) AS w FROM cs a JOIN cs b ON a.cluster_id <> b.cluster_id GROUP BY 1)""",
        f"SELECT {r('avg(w)', 6)} AS davies_bouldin FROM worst",
    ),
)
def davies_bouldin(spark, sf_dir):
    df = materialise(segmented(spark, sf_dir).select("cluster_id", *_QUALITY_FEATURES), "segmented")
    return rounded(S.davies_bouldin(df, _QUALITY_FEATURES), 6, "davies_bouldin")


_IMPUTED = ", ".join(f"quantile_cont(CAST({c} AS DOUBLE), 0.5) AS {c}_m" for c in K.CLUSTER_FEATURES)
_FILLED = ", ".join(f"coalesce(CAST({c} AS DOUBLE), {c}_m) AS {c}" for c in K.CLUSTER_FEATURES)
_STATS = ", ".join(f"avg({c}) AS {c}_avg, stddev_pop({c}) AS {c}_std" for c in K.CLUSTER_FEATURES)
_SCALED = ", ".join(
    f"{r(f'({c} - {c}_avg) / (CASE WHEN {c}_std = 0 THEN 1e0 ELSE {c}_std END)', 6)} AS {c}" for c in K.CLUSTER_FEATURES
)


@query(
    "cluster_matrix",
    with_(
        f"""{FEATURED},
  med AS (SELECT {_IMPUTED} FROM f), fi AS (SELECT player_id, {_FILLED} FROM f, med), st AS (SELECT {_STATS} FROM fi)""",
        f"SELECT player_id, {_SCALED} FROM fi, st",
    ),
)
def cluster_matrix(spark, sf_dir):
    matrix, features = S.cluster_matrix(materialise(featured(spark, sf_dir), "featured"))
    return rounded(matrix, 6, *features)


@query(
    "intervention_tiers",
    with_(SEGMENTED, """SELECT player_id, segment, CASE WHEN consecutive_losses >= 5 AND last_login_days_ago >= 20 THEN 'Tier 1 (24-48h)'
      WHEN segment = 'Casual' AND coalesce(total_spend_usd, 0e0) <= 0 THEN 'Tier 2 (weekly)'
      WHEN segment IN ('Champions', 'Whales') THEN 'Tier 3 (monthly)' ELSE 'None' END AS intervention FROM s"""),
)
def intervention_tiers(spark, sf_dir):
    return segmented_only(spark, sf_dir, "consecutive_losses").select("player_id", "segment", intervention_tier().alias("intervention"))


# ---- fitted clustering ------------------------------------------------------------------------

def _matrix(spark, sf_dir):
    df = materialise(featured(spark, sf_dir), "featured")
    matrix, features = S.cluster_matrix(df)
    return df, materialise(matrix, "clusters"), features


@query("kmeans_segment_profile")
def kmeans_segment_profile(spark, sf_dir):
    df, _, _ = S.segment_players(materialise(featured(spark, sf_dir), "featured"))
    return A.segment_profile(materialise(df, "segmented"))


@query("segmenter_round_trip", with_(FEATURED, "SELECT count(*) AS players, count(*) AS same, 4::BIGINT AS segments FROM f"))
def segmenter_round_trip(spark, sf_dir):
    """A stored segmenter gives every player the segment that the fitted one gives."""
    df = materialise(featured(spark, sf_dir), "featured")
    fitted = S.fit_segmenter(df)
    loaded = S.Segmenter.load(spark, fitted.save(spark, new_path(spark, "segmenter")))
    both = fitted.segments(df).join(loaded.segments(df).withColumnRenamed("segment", "again"), ["player_id", "cluster_id"])
    return both.agg(F.count("*").alias("players"), F.count_if(F.col("segment") == F.col("again")).alias("same"), F.countDistinct("segment").alias("segments"))


@query("kmeans_scan")
def kmeans_scan(spark, sf_dir):
    _, matrix, features = _matrix(spark, sf_dir)
    return S.scan_k(matrix, features, range(2, 9))


@query("kmeans_silhouette")
def kmeans_silhouette(spark, sf_dir):
    _, matrix, features = _matrix(spark, sf_dir)
    assigned = S.assign(matrix, features, S.fit_kmeans(matrix, features))
    return S.silhouette_by_cluster(materialise(assigned, "assigned"), features)


@query("kmeans_embeddings_quality")
def kmeans_embeddings_quality(spark, sf_dir):
    """Clustering of the embedding vectors and its Davies-Bouldin index."""
    table = read_table(spark, sf_dir, "embeddings")
    dims = len(table.select("embedding").first()[0])
    names = [f"e{i}" for i in range(dims)]
    matrix = materialise(table.select("vec_id", *[F.col("embedding")[i].cast("double").alias(n) for i, n in enumerate(names)]), "embeddings")
    assigned = S.assign(matrix, names, S.fit_kmeans(matrix, names, k=10))
    return S.davies_bouldin(materialise(assigned, "assigned"), names)


@query("pca_scatter")
def pca_scatter(spark, sf_dir):
    df, matrix, features = _matrix(spark, sf_dir)
    points, explained = S.project_2d(matrix, features)
    return points.join(rule_segments(df).select("player_id", "segment"), "player_id").withColumn(
        "explained_pct", round_even(F.lit(explained), 1)
    )


@query(
    "fallback_scatter",
    with_(SEGMENTED, """SELECT player_id, engagement_score, rfm_score, segment, session_count, total_spend_usd, win_rate FROM s"""),
)
def fallback_scatter(spark, sf_dir):
    return S.fallback_scatter(segmented(spark, sf_dir))
