"""Curves and metrics over a table of (score, label); tied scores are one point."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapsewise.functions.numeric import clip, count_if, ratio, ratio_or_zero, round_even
from lapsewise.operators.ranks import collapse, running_totals


def threshold_counts(df: DataFrame, score: str, label: str, by: list[str] = ()) -> DataFrame:
    """One row per distinct score s: tp and fp when everything scoring >= s is called positive."""
    flagged = df.select(*by, F.col(score).cast("double").alias("score"), F.col(label).cast("bigint").alias("y"))
    placed = collapse(flagged, "score", list(by), sums={"pos": F.col("y")})
    ranked = running_totals(placed, "score", ["n", "pos"], list(by), descending=True)
    return ranked.select(
        *by, "score", "n", "pos",
        F.col("cum_pos").alias("tp"),
        (F.col("cum_n") - F.col("cum_pos")).alias("fp"),
        F.col("total_pos").alias("positives"),
        (F.col("total_n") - F.col("total_pos")).alias("negatives"),
    )


def _precision_recall(points: DataFrame) -> DataFrame:
    return points.withColumn("precision", ratio(F.col("tp"), F.col("tp") + F.col("fp"))).withColumn(
        "recall", ratio(F.col("tp"), F.col("positives"))
    )


def pr_curve(df: DataFrame, score: str, label: str) -> DataFrame:
    """(threshold, precision, recall), closed by the point (null, 1, 0)."""
    points = _precision_recall(threshold_counts(df, score, label)).select(
        F.col("score").alias("threshold"), "precision", "recall"
    )
    end = df.sparkSession.range(1).select(
        F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall")
    )
    return points.unionByName(end)


def with_f1(points: DataFrame) -> DataFrame:
    p, r = F.col("precision"), F.col("recall")
    return points.withColumn("f1", 2.0 * p * r / (p + r + 1e-8))


def best_threshold(df: DataFrame, score: str, label: str, by: list[str] = ()) -> DataFrame:
    """(by..., threshold, f1): the score with the best F1, the lowest such score on ties."""
    points = with_f1(_precision_recall(threshold_counts(df, score, label, by)))
    top = F.max(F.struct(F.col("f1"), (-F.col("score")).alias("minus"))).alias("top")
    best = points.groupBy(*by).agg(top) if by else points.agg(top)
    return best.select(*by, (-F.col("top.minus")).alias("threshold"), F.col("top.f1").alias("f1"))


def roc_curve(df: DataFrame, score: str, label: str) -> DataFrame:
    """(threshold, fpr, tpr), opened by the point (null, 0, 0)."""
    points = threshold_counts(df, score, label).select(
        F.col("score").alias("threshold"),
        ratio(F.col("fp"), F.col("negatives")).alias("fpr"),
        ratio(F.col("tp"), F.col("positives")).alias("tpr"),
    )
    start = df.sparkSession.range(1).select(
        F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    return points.unionByName(start)


def _auc_column():
    # A positive beats every negative with a lower score and half of those with the same score.
    same = F.col("n") - F.col("pos")
    below = F.col("negatives") - F.col("fp")
    wins = F.sum(F.col("pos").cast("double") * (below.cast("double") + same.cast("double") / 2.0))
    return F.try_divide(wins, F.max(F.col("positives").cast("double") * F.col("negatives").cast("double")))


def _ap_column():
    # Recall grows by pos / positives at each score; no lag over the curve is needed.
    step = F.sum(F.col("pos").cast("double") * F.col("precision"))
    return F.try_divide(step, F.max(F.col("positives").cast("double")))


def ranking_quality(df: DataFrame, score: str, label: str, by: list[str] = ()) -> DataFrame:
    """(by..., roc_auc, avg_precision) from one pass; null when a class is missing."""
    points = _precision_recall(threshold_counts(df, score, label, by))
    cells = [_auc_column().alias("roc_auc"), _ap_column().alias("avg_precision")]
    return points.groupBy(*by).agg(*cells) if by else points.agg(*cells)


def roc_auc(df: DataFrame, score: str, label: str) -> DataFrame:
    return ranking_quality(df, score, label).select("roc_auc")


def average_precision(df: DataFrame, score: str, label: str) -> DataFrame:
    return ranking_quality(df, score, label).select("avg_precision")


def classification_report(df: DataFrame, predicted: str, label: str, by: list[str] = ()) -> DataFrame:
    """Precision, recall and F1 of class 1 and the macro F1, 0 where undefined, 4 digits."""
    p, y = F.col(predicted) == 1, F.col(label) == 1
    counts = df.groupBy(*by).agg(
        count_if(p & y).alias("tp"), count_if(p & ~y).alias("fp"),
        count_if(~p & y).alias("fn"), count_if(~p & ~y).alias("tn"),
    )
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    f1 = ratio_or_zero(2 * tp, 2 * tp + fp + fn)
    f0 = ratio_or_zero(2 * tn, 2 * tn + fp + fn)
    return counts.select(
        *by,
        round_even(f1, 4).alias("f1_churn"),
        round_even(ratio_or_zero(tp, tp + fp), 4).alias("precision_churn"),
        round_even(ratio_or_zero(tp, tp + fn), 4).alias("recall_churn"),
        round_even((f1 + f0) / 2.0, 4).alias("f1_macro"),
    )


def confusion_matrix(df: DataFrame, predicted: str, label: str) -> DataFrame:
    """(actual, predicted, n, share): share within the actual class."""
    cells = df.groupBy(F.col(label).alias("actual"), F.col(predicted).alias("predicted")).agg(
        F.count(F.lit(1)).alias("n")
    )
    rows = cells.groupBy("actual").agg(F.sum("n").alias("total"))
    return cells.join(F.broadcast(rows), "actual").select(
        "actual", "predicted", "n", (F.col("n") / F.col("total")).alias("share")
    )


def calibration_curve(df: DataFrame, score: str, label: str, bins: int = 10) -> DataFrame:
    """(bin, n, mean_score, mean_label) of the non-empty right-closed bins of [0, 1]."""
    bin_id = clip(F.ceil(F.col(score) * float(bins)) - 1, 0, bins - 1).cast("bigint")
    return df.groupBy(bin_id.alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.avg(score).alias("mean_score"),
        F.avg(F.col(label).cast("double")).alias("mean_label"),
    )


def comparison_table(scored: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Eight columns per model over (model, score, label), sorted by AUC then name.

    ``thresholds`` has one row per model.
    """
    cut = scored.join(F.broadcast(thresholds.select("model", "threshold")), "model").withColumn(
        "predicted", (F.col("score") >= F.col("threshold")).cast("int")
    )
    quality = ranking_quality(scored, "score", "label", ["model"])
    report = classification_report(cut, "predicted", "label", ["model"])
    return (
        quality.join(F.broadcast(report), "model")
        .join(F.broadcast(thresholds.select("model", "threshold")), "model")
        .select(
            "model",
            round_even(F.col("roc_auc"), 4).alias("test_auc"),
            round_even(F.col("avg_precision"), 4).alias("avg_precision"),
            "f1_churn", "precision_churn", "recall_churn", "f1_macro",
            round_even(F.col("threshold"), 4).alias("threshold"),
        )
        .orderBy(F.desc("test_auc"), "model")
    )
