"""Resampling, training, tuning, attribution and scoring with fitted models (rows checked by tests)."""

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from lapsewise import constants as K
from lapsewise.operators import explain as G
from lapsewise.operators import models as M
from lapsewise.operators import scoring as V
from lapsewise.operators.clean import assemble
from lapsewise.operators.resample import smote
from lapsewise.operators.split import class_distribution, with_class_weight, with_folds
from lapsewise.operators.tree_paths import base_value, top_reasons, tree_attributions, tree_paths, waterfall
from lapsewise.plans import stages
from lapsewise.queries.base import PLAYERS, enriched, query, stored_players, with_
from lapsewise.queries.scoring import records
from lapsewise.queries.tables import SPLIT_SQL
from lapsewise.sources.workspace import materialise, new_path
from lapsewise.streaming.scoring import read_records, start_scoring

# A small ensemble for the queries that show serving; the others are tuned by the operators' defaults.
BOOSTED = {"maxIter": 10, "maxDepth": 3, "stepSize": 0.2}


def matrices(spark, sf_dir):
    return stages.split_matrices(enriched(spark, sf_dir))


_TRAIN_COUNTS = f"ct AS (SELECT churn_label, count(*) AS n FROM p WHERE {SPLIT_SQL} = 'train' GROUP BY 1)"


@query("balanced_class_counts", with_(f"{PLAYERS},\n{_TRAIN_COUNTS}", "SELECT churn_label, (SELECT max(n) FROM ct) AS players FROM ct"))
def balanced_class_counts(spark, sf_dir):
    m = matrices(spark, sf_dir)
    return class_distribution(smote(m.part("train"), m.preprocessor.feature_names))


@query(
    "smote_invariants",
    with_(f"{PLAYERS},\n{_TRAIN_COUNTS},\n gap AS (SELECT *, (SELECT max(n) FROM ct) - n AS missing FROM ct)",
          """SELECT churn_label, n AS originals, missing AS made, CASE WHEN missing > 0 THEN missing // n END AS fewest,
      CASE WHEN missing > 0 THEN (missing + n - 1) // n END AS most, CAST(0 AS BIGINT) AS other_ends, CAST(0 AS BIGINT) AS off_segment FROM gap"""),
)
def smote_invariants(spark, sf_dir):
    """New rows of each class, how many a base row has at least and at most, and how many break a rule: ends that
    are no row of the class, values that aren't base + gap x (end - base) with a gap of 0 to 1."""
    m = matrices(spark, sf_dir)
    names = m.preprocessor.feature_names
    rows = materialise(smote(m.part("train"), names, trace=True), "smote")
    own = rows.where("NOT synthetic").select(K.ID, K.LABEL, F.array(*names).alias("x"))
    made = rows.where("synthetic").select("base_key", "near_key", "gap", F.col(K.LABEL).alias("label"), F.array(*names).alias("got"))
    base = own.select(F.col(K.ID).alias("base_key"), F.col(K.LABEL).alias("base_label"), F.col("x").alias("base"))
    end = own.select(F.col(K.ID).alias("near_key"), F.col(K.LABEL).alias("end_label"), F.col("x").alias("end"))
    both = made.join(base, "base_key", "left").join(end, "near_key", "left")
    on = F.zip_with(F.zip_with("base", "end", lambda a, b: a + F.col("gap") * (b - a)), "got", lambda a, b: F.abs(a - b) <= 1e-9)
    right = F.col("gap").between(0, 1) & F.forall(on, lambda x: F.coalesce(x, F.lit(False)))
    inside = (F.col("base_label") == F.col("label")) & (F.col("end_label") == F.col("label"))
    wrong = lambda c: F.sum((~F.coalesce(c, F.lit(False))).cast("bigint"))
    each = both.groupBy("label", "base_key").agg(F.count(F.lit(1)).alias("made"), wrong(inside).alias("other_ends"), wrong(right).alias("off_segment"))
    # a base row without a new one has none
    counted = own.join(each.drop("label"), own[K.ID] == each["base_key"], "left").na.fill(0, ["made", "other_ends", "off_segment"])
    made_any = F.sum("made") > 0
    return counted.groupBy(K.LABEL).agg(
        F.count(F.lit(1)).alias("originals"), F.sum("made").alias("made"), F.when(made_any, F.min("made")).alias("fewest"),
        F.when(made_any, F.max("made")).alias("most"), F.sum("other_ends").alias("other_ends"), F.sum("off_segment").alias("off_segment"),
    )


@query("smote_rows")
def smote_rows(spark, sf_dir):
    m = matrices(spark, sf_dir)
    return smote(m.part("train"), m.preprocessor.feature_names)


@query("model_comparison")
def model_comparison(spark, sf_dir):
    _, table = stages.train_and_compare(matrices(spark, sf_dir))
    return table


@query("model_comparison_without_proxies")
def model_comparison_without_proxies(spark, sf_dir):
    _, table = stages.train_and_compare(matrices(spark, sf_dir), drop_label_proxies=True)
    return table


@query("random_search")
def random_search(spark, sf_dir):
    m = matrices(spark, sf_dir)
    train = with_folds(with_class_weight(m.part("train")), 5)
    ready = M.fit_table(train, M.model_features(m.preprocessor, True))
    try:
        _, trials = M.random_search(ready, "BoostedTreesDepth")
    finally:
        ready.unpersist()
    return trials


def _boosted_bundle(spark, sf_dir, fixed=None, rows=None):
    m = matrices(spark, sf_dir) if rows is None else stages.split_matrices(stages.enrich(rows))
    fitted = stages.train(m, balance=False, names=["BoostedTreesDepth"], fixed=fixed, drop_label_proxies=True, seconds=120.0)
    return m, M.best_bundle(fitted)


@query("tree_contributions")
def tree_contributions(spark, sf_dir):
    m, bundle = _boosted_bundle(spark, sf_dir)
    return G.tree_contributions(m.table, bundle.features, bundle.model)


@query("tree_risk_table")
def tree_risk_table(spark, sf_dir):
    rows = stored_players(spark, sf_dir)
    m, bundle = _boosted_bundle(spark, sf_dir, rows=rows)
    return stages.explain_risk(bundle, m.part("test"), rows)[1]


def _explained(spark, sf_dir):
    """Matrix, bundle, base value and attributions of a fixed small ensemble."""
    m, bundle = _boosted_bundle(spark, sf_dir, {"BoostedTreesDepth": BOOSTED})
    paths = tree_paths(spark, bundle.model, len(bundle.features))
    return m, bundle, base_value(paths), tree_attributions(m.table, bundle.features, bundle.model, paths=paths)


@query("tree_additivity", with_(PLAYERS, "SELECT count(*) AS players, count(*) AS additive FROM p"))
def tree_additivity(spark, sf_dir):
    """Players whose base value and contributions add up to the model's margin."""
    m, bundle, base, found = _explained(spark, sf_dir)
    margin = bundle.model.transform(assemble(m.table, bundle.features)).select(K.ID, vector_to_array("rawPrediction")[1].alias("margin"))
    added = F.aggregate("contributions", F.lit(base), lambda a, x: a + x)
    both = found.select(K.ID, added.alias("added")).join(margin, K.ID)
    return both.agg(F.count("*").alias("players"), F.count_if(F.abs(F.col("added") - F.col("margin")) < 1e-9).alias("additive"))


@query("tree_top_reasons")
def tree_top_reasons(spark, sf_dir):
    """The three largest contributions of every player, from one array each."""
    _, bundle, _, found = _explained(spark, sf_dir)
    return top_reasons(found, bundle.features).select(K.ID, F.concat_ws(",", "reasons.feature").alias("reasons"))


@query("tree_waterfall")
def tree_waterfall(spark, sf_dir):
    """Base value and ordered contributions of the player with the highest probability."""
    m, bundle, base, found = _explained(spark, sf_dir)
    first = G.top_risk(M.score(bundle.model, assemble(m.table, bundle.features)).select(K.ID, "churn_prob"), 1)
    return waterfall(found.join(F.broadcast(first.select(K.ID)), K.ID, "left_semi"), bundle.features, base)


@query("score_saved_bundle")
def score_saved_bundle(spark, sf_dir):
    m, bundle = _boosted_bundle(spark, sf_dir, {"BoostedTreesDepth": BOOSTED})
    loaded = M.Bundle.load(spark, bundle.save(spark, new_path(spark, "bundle")))
    return M.score(loaded.model, assemble(m.table, loaded.features)).select(K.ID, "split", "churn_prob")


@query("score_records")
def score_records(spark, sf_dir):
    rows = stored_players(spark, sf_dir)
    _, bundle = _boosted_bundle(spark, sf_dir, {"BoostedTreesDepth": BOOSTED}, rows)
    return V.score_records(records(spark, sf_dir, rows), bundle).drop("record", "input_summary")


@query("what_if")
def what_if(spark, sf_dir):
    rows = stored_players(spark, sf_dir)
    _, bundle = _boosted_bundle(spark, sf_dir, {"BoostedTreesDepth": BOOSTED}, rows)
    scenarios = [
        {"scenario": "as is"},
        {"scenario": "no spend", "total_spend_usd": 0},
        {"scenario": "losing", "consecutive_losses": 10, "win_rate": 0.2},
        {"scenario": "co-op", K.MODE: "Co-op", "friend_count": 30},
    ]
    return V.what_if(rows, scenarios, bundle).select(K.ID, "scenario", "churn_prob", "tier")


@query("stream_scored_records")
def stream_scored_records(spark, sf_dir):
    rows = stored_players(spark, sf_dir)
    _, bundle = _boosted_bundle(spark, sf_dir, {"BoostedTreesDepth": BOOSTED}, rows)
    source = new_path(spark, "incoming")
    records(spark, sf_dir, rows).select("record").write.text(source)
    scored, rejected, progress = (new_path(spark, n) for n in ("scored", "rejected", "progress"))
    for running in start_scoring(read_records(spark, source), bundle, scored, rejected, progress):
        running.awaitTermination()
    good = spark.read.parquet(scored).select("record", "churn_probability", "risk_tier")
    bad = spark.read.parquet(rejected).select("record", F.lit(None).cast("double").alias("churn_probability"), F.lit("rejected").alias("risk_tier"))
    return good.unionByName(bad)
