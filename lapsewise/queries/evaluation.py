"""Curves and metrics of a deterministic score: 1 - engagement / 100 against the churn label."""

from pyspark.sql import functions as F

from lapsewise.operators import evaluate as E
from lapsewise.operators import explain as G
from lapsewise.operators.enrich import engineer_features
from lapsewise.queries.base import PLAYERS, feature_sql, players, query, r, rounded, with_
from lapsewise.sources.workspace import materialise

_COLUMNS = ["player_id", "session_count", "avg_session_duration", "last_login_days_ago", "total_playtime_hours", "win_rate",
            "total_spend_usd", "friend_count", "achievement_count", "consecutive_losses", "churn_label"]
# Two scores that stand in for models.
_SCORES = {"engagement": "1e0 - engagement_score / 1e2", "losses": "loss_streak_risk"}


def scores(spark, sf_dir):
    df = engineer_features(players(spark, sf_dir, _COLUMNS))
    return df.select("player_id", (1.0 - F.col("engagement_score") / 100.0).alias("score"), F.col("churn_label").alias("label"))


def two_models(spark, sf_dir):
    df = engineer_features(players(spark, sf_dir, _COLUMNS))
    label = F.col("churn_label").alias("label")
    return materialise(
        df.select(F.lit("engagement").alias("model"), (1.0 - F.col("engagement_score") / 100.0).alias("score"), label).unionByName(
            df.select(F.lit("losses").alias("model"), F.col("loss_streak_risk").alias("score"), label)
        ),
        "scores",
    )


def _points(source: str, by: str = "") -> str:
    keys = f"{by}, " if by else ""
    part = f"PARTITION BY {by} " if by else ""
    group = f"PARTITION BY {by}" if by else ""
    return f"""g AS (SELECT {keys}score, count(*) AS n, sum(label) AS pos FROM {source} GROUP BY {keys}score),
  pt AS (SELECT {keys}score, n, pos, sum(pos) OVER ({part}ORDER BY score DESC) AS tp, sum(n - pos) OVER ({part}ORDER BY score DESC) AS fp,
         sum(pos) OVER ({group}) AS positives, sum(n - pos) OVER ({group}) AS negatives FROM g),
  pr AS (SELECT *, CAST(tp AS DOUBLE) / (tp + fp) AS prec, CAST(tp AS DOUBLE) / positives AS rec FROM pt),
  f1 AS (SELECT *, 2e0 * prec * rec / (prec + rec + 1e-8) AS f1 FROM pr)"""


_SC = f"{PLAYERS},\nf AS ({feature_sql('p')}),\nsc AS (SELECT player_id, {_SCORES['engagement']} AS score, churn_label AS label FROM f)"
SCORED = f"{_SC},\n{_points('sc')}"
_TWO = f"""{PLAYERS},\nf AS ({feature_sql('p')}),
  sc AS ({" UNION ALL ".join(f"SELECT '{m}' AS model, {e} AS score, churn_label AS label FROM f" for m, e in _SCORES.items())}),
  {_points('sc', 'model')}"""
_AUC = "sum(CAST(pos AS DOUBLE) * (CAST(negatives - fp AS DOUBLE) + CAST(n - pos AS DOUBLE) / 2e0)) / max(CAST(positives AS DOUBLE) * CAST(negatives AS DOUBLE))"
_AP = "sum(CAST(pos AS DOUBLE) * prec) / max(CAST(positives AS DOUBLE))"


@query("threshold_counts", with_(SCORED, """SELECT score, n, CAST(pos AS BIGINT) AS pos, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp,
  CAST(positives AS BIGINT) AS positives, CAST(negatives AS BIGINT) AS negatives FROM pt"""))
def threshold_counts(spark, sf_dir):
    return E.threshold_counts(scores(spark, sf_dir), "score", "label")


@query(
    "pr_curve",
    with_(SCORED, f"""SELECT score AS threshold, {r("prec", 9)} AS precision, {r("rec", 9)} AS recall FROM pr
      UNION ALL SELECT NULL, 1e0, 0e0"""),
)
def pr_curve(spark, sf_dir):
    return rounded(E.pr_curve(scores(spark, sf_dir), "score", "label"), 9, "precision", "recall")


@query("best_threshold", with_(SCORED, f"SELECT score AS threshold, {r('f1', 9)} AS f1 FROM f1 ORDER BY f1.f1 DESC, score LIMIT 1"))
def best_threshold(spark, sf_dir):
    return rounded(E.best_threshold(scores(spark, sf_dir), "score", "label"), 9, "f1")


@query(
    "roc_curve",
    with_(SCORED, f"""SELECT score AS threshold, {r("CAST(fp AS DOUBLE) / negatives", 9)} AS fpr, {r("rec", 9)} AS tpr FROM pr
      UNION ALL SELECT NULL, 0e0, 0e0"""),
)
def roc_curve(spark, sf_dir):
    return rounded(E.roc_curve(scores(spark, sf_dir), "score", "label"), 9, "fpr", "tpr")


@query("roc_auc", with_(SCORED, f"SELECT {r(_AUC, 9)} AS roc_auc FROM pr"))
def roc_auc(spark, sf_dir):
    return rounded(E.roc_auc(scores(spark, sf_dir), "score", "label"), 9, "roc_auc")


@query("average_precision", with_(SCORED, f"SELECT {r(_AP, 9)} AS avg_precision FROM pr"))
def average_precision(spark, sf_dir):
    return rounded(E.average_precision(scores(spark, sf_dir), "score", "label"), 9, "avg_precision")


def _report(by: str, predicted: str, source: str) -> str:
    keys = f"{by}, " if by else ""
    group = f"GROUP BY {by}" if by else ""
    f1 = "coalesce(2e0 * tp / nullif(2 * tp + fp + fn, 0), 0e0)"
    f0 = "coalesce(2e0 * tn / nullif(2 * tn + fp + fn, 0), 0e0)"
    return f"""cc AS (SELECT {keys}count(*) FILTER (WHERE {predicted} AND label = 1) AS tp, count(*) FILTER (WHERE {predicted} AND label = 0) AS fp,
    count(*) FILTER (WHERE NOT {predicted} AND label = 1) AS fn, count(*) FILTER (WHERE NOT {predicted} AND label = 0) AS tn FROM {source} {group}),
  rp AS (SELECT {keys}{r(f1, 4)} AS f1_churn, {r("coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 0e0)", 4)} AS precision_churn,
    {r("coalesce(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 0e0)", 4)} AS recall_churn, {r(f"({f1} + {f0}) / 2e0", 4)} AS f1_macro FROM cc)"""


@query("classification_report", with_(f"{_SC},\n{_report('', 'score >= 7e-1', 'sc')}", "SELECT * FROM rp"))
def classification_report(spark, sf_dir):
    df = scores(spark, sf_dir).withColumn("predicted", (F.col("score") >= 0.7).cast("int"))
    return E.classification_report(df, "predicted", "label")


@query(
    "confusion_matrix",
    with_(_SC, f"""SELECT label AS actual, CAST(score >= 7e-1 AS INTEGER) AS predicted, count(*) AS n,
      {r("count(*) / sum(count(*)) OVER (PARTITION BY label)", 9)} AS share FROM sc GROUP BY 1, 2"""),
)
def confusion_matrix(spark, sf_dir):
    df = scores(spark, sf_dir).withColumn("predicted", (F.col("score") >= 0.7).cast("int"))
    return rounded(E.confusion_matrix(df, "predicted", "label"), 9, "share")


@query(
    "calibration_curve",
    with_(_SC, f"""SELECT CAST(least(greatest(ceil(score * 1e1) - 1, 0), 9) AS BIGINT) AS bin, count(*) AS n, {r("avg(score)", 9)} AS mean_score,
      {r("avg(CAST(label AS DOUBLE))", 9)} AS mean_label FROM sc GROUP BY 1"""),
)
def calibration_curve(spark, sf_dir):
    return rounded(E.calibration_curve(scores(spark, sf_dir), "score", "label"), 9, "mean_score", "mean_label")


@query(
    "comparison_table",
    with_(f"""{_TWO},
  th AS (SELECT model, score AS threshold FROM (SELECT *, row_number() OVER (PARTITION BY model ORDER BY f1 DESC, score) AS rn FROM f1) WHERE rn = 1),
  ql AS (SELECT model, {r(_AUC, 4)} AS test_auc, {r(_AP, 4)} AS avg_precision FROM pr GROUP BY 1),
  cut AS (SELECT sc.model AS model, score >= threshold AS hit, label FROM sc JOIN th ON th.model = sc.model),
  {_report("model", "hit", "cut")}""",
          f"""SELECT ql.model AS model, test_auc, avg_precision, f1_churn, precision_churn, recall_churn, f1_macro, {r("threshold", 4)} AS threshold
      FROM ql JOIN rp ON rp.model = ql.model JOIN th ON th.model = ql.model"""),
)
def comparison_table(spark, sf_dir):
    df = two_models(spark, sf_dir)
    return E.comparison_table(df, materialise(E.best_threshold(df, "score", "label", ["model"]), "thresholds"))


@query(
    "best_candidate",
    with_(f"{_TWO},\nql AS (SELECT model, {r(_AUC, 6)} AS val_auc FROM pr GROUP BY 1)", "SELECT model, val_auc FROM ql ORDER BY val_auc DESC, model LIMIT 1"),
)
def best_candidate(spark, sf_dir):
    quality = E.ranking_quality(two_models(spark, sf_dir), "score", "label", ["model"])
    return rounded(quality.select("model", F.col("roc_auc").alias("val_auc")), 6, "val_auc").orderBy(F.desc("val_auc"), "model").limit(1)


# ---- attributions of a linear score with given coefficients -------------------------------------

COEFFICIENTS = {
    "session_count": -0.08,
    "last_login_days_ago": 0.004,
    "win_rate": -1.5,
    "total_spend_usd": -0.01,
    "friend_count": -0.05,
    "achievement_count": -0.02,
    "consecutive_losses": 0.3,
}


def linear_inputs(spark, sf_dir):
    df = materialise(players(spark, sf_dir, _COLUMNS), "players")
    filled = df.select("player_id", *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in COEFFICIENTS])
    return df, G.linear_contributions(filled, list(COEFFICIENTS), list(COEFFICIENTS.values()))


LINEAR = f"""{PLAYERS},
  fl AS (SELECT player_id, {", ".join(f"coalesce(CAST({c} AS DOUBLE), 0e0) AS {c}" for c in COEFFICIENTS)} FROM p),
  mn AS (SELECT {", ".join(f"avg({c}) AS {c}" for c in COEFFICIENTS)} FROM fl),
  att AS ({" UNION ALL ".join(f"SELECT player_id, '{c}' AS feature, fl.{c} AS value, {w}::DOUBLE * (fl.{c} - mn.{c}) AS contribution FROM fl, mn" for c, w in COEFFICIENTS.items())})"""


@query("linear_contributions", with_(LINEAR, f"SELECT player_id, feature, value, {r('contribution', 6)} AS contribution FROM att"))
def linear_contributions(spark, sf_dir):
    return rounded(linear_inputs(spark, sf_dir)[1], 6, "contribution")


@query("global_importance", with_(LINEAR, f"SELECT feature, {r('avg(abs(contribution))', 6)} AS mean_abs_contribution FROM att GROUP BY 1"))
def global_importance(spark, sf_dir):
    return rounded(G.global_importance(linear_inputs(spark, sf_dir)[1]), 6, "mean_abs_contribution")


@query(
    "top_features",
    with_(LINEAR, f"SELECT feature, {r('avg(abs(contribution))', 6)} AS mean_abs_contribution FROM att GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5"),
)
def top_features(spark, sf_dir):
    return rounded(G.top_features(linear_inputs(spark, sf_dir)[1], 15, 5), 6, "mean_abs_contribution")


@query(
    "beeswarm_points",
    with_(LINEAR, f"""SELECT player_id, feature, value, {r('contribution', 6)} AS contribution FROM att
      WHERE feature IN (SELECT feature FROM att GROUP BY 1 ORDER BY avg(abs(contribution)) DESC, feature LIMIT 3)"""),
)
def beeswarm_points(spark, sf_dir):
    return rounded(G.beeswarm(linear_inputs(spark, sf_dir)[1], 3), 6, "contribution")


# Probability of the linear score: 1 / (1 + exp(-sum of contributions)).
_PROB = f"{LINEAR},\npb AS (SELECT player_id, {r('1e0 / (1e0 + exp(-sum(contribution)))', 9)} AS churn_prob FROM att GROUP BY 1)"


def linear_scored(spark, sf_dir):
    df, attributions = linear_inputs(spark, sf_dir)
    prob = attributions.groupBy("player_id").agg((1.0 / (1.0 + F.exp(-F.sum("contribution")))).alias("churn_prob"))
    prob = rounded(prob, 9, "churn_prob")
    return df, attributions, materialise(prob.join(df.select("player_id", "churn_label"), "player_id"), "scored")


@query(
    "waterfall",
    with_(_PROB, f"""SELECT player_id, feature, value, {r("contribution", 6)} AS contribution, 0e0 AS base_value FROM att
      WHERE player_id = (SELECT player_id FROM pb ORDER BY churn_prob DESC, player_id LIMIT 1)"""),
)
def waterfall(spark, sf_dir):
    _, attributions, scored = linear_scored(spark, sf_dir)
    return rounded(G.waterfall(attributions, scored, 0.0), 6, "contribution")


@query("top_risk", with_(_PROB, "SELECT player_id, churn_prob FROM pb ORDER BY churn_prob DESC, player_id LIMIT 20"))
def top_risk(spark, sf_dir):
    return G.top_risk(linear_scored(spark, sf_dir)[2], 20).select("player_id", "churn_prob")


_REASONS = """rk AS (SELECT player_id, feature, contribution, row_number() OVER (PARTITION BY player_id ORDER BY abs(contribution) DESC, feature) AS pos FROM att)"""


@query(
    "top_reasons",
    with_(f"{LINEAR},\n{_REASONS}", "SELECT player_id, string_agg(feature, ',' ORDER BY pos) AS reasons FROM rk WHERE pos <= 3 GROUP BY 1"),
)
def top_reasons(spark, sf_dir):
    _, attributions = linear_inputs(spark, sf_dir)
    return G.top_reasons(attributions).select("player_id", F.concat_ws(",", "reasons.feature").alias("reasons"))


def _narrative_sql() -> str:
    trend = "CASE WHEN contribution > 0 THEN 'increases' ELSE 'decreases' END"
    tail = f"' (' || {trend} || ' churn risk)'"
    whole = "CAST(CAST({} AS BIGINT) AS VARCHAR)"
    return f"""CASE
      WHEN feature = 'last_login_days_ago' THEN 'Last login ' || {whole.format("last_login_days_ago")} || ' days ago' || {tail}
      WHEN feature = 'consecutive_losses' THEN {whole.format("consecutive_losses")} || ' consecutive losses' || {tail}
      WHEN feature = 'total_spend_usd' THEN 'Total spend ' || coalesce('$' || {whole.format("round_even(total_spend_usd, 0)")}, 'unknown') || {tail}
      WHEN feature = 'session_count' THEN {whole.format("session_count")} || ' sessions total' || {tail}
      WHEN feature = 'win_rate' THEN 'Win rate ' || coalesce({whole.format("round_even(win_rate * 1e2, 0)")} || '%', 'unknown') || {tail}
      WHEN feature = 'friend_count' THEN coalesce({whole.format("friend_count")} || ' in-game friends', 'Friend count unknown') || {tail}
      ELSE 'Feature ''' || feature || ''' ' || {trend} || ' churn risk' END"""


@query(
    "risk_narratives",
    with_(f"{LINEAR},\n{_REASONS}", f"""SELECT rk.player_id AS player_id, string_agg({_narrative_sql()}, ' | ' ORDER BY pos) AS risk_narrative
      FROM rk JOIN p ON p.player_id = rk.player_id WHERE pos <= 3 GROUP BY 1"""),
)
def risk_narratives(spark, sf_dir):
    df, attributions = linear_inputs(spark, sf_dir)
    return G.top_reasons(attributions).join(df, "player_id").select(
        "player_id", G.risk_narrative(F.col("reasons")).alias("risk_narrative")
    )


@query(
    "risk_table",
    with_(f"{_PROB},\n{_REASONS},\ntp AS (SELECT * FROM pb ORDER BY churn_prob DESC, player_id LIMIT 20)",
          f"""SELECT rk.player_id AS player_id, max(churn_prob) AS churn_prob, CAST(max(churn_prob) >= 9e-1 AS INTEGER) AS predicted_churn,
      max(churn_label) AS actual_churn, string_agg({_narrative_sql()}, ' | ' ORDER BY pos) AS risk_narrative
      FROM tp JOIN rk ON rk.player_id = tp.player_id JOIN p ON p.player_id = rk.player_id WHERE pos <= 3 GROUP BY 1"""),
)
def risk_table(spark, sf_dir):
    df, attributions, scored = linear_scored(spark, sf_dir)
    return G.risk_table(scored, attributions, df, 0.9, 20)
