"""Curves and metrics against direct definitions."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lapsewise.operators import evaluate as E


def frame(spark, scores, labels):
    return spark.createDataFrame([(float(s), int(y)) for s, y in zip(scores, labels)], "score double, label int")


def brute_auc(scores, labels):
    pos, neg = scores[labels == 1], scores[labels == 0]
    return float(np.mean([(p > neg).mean() + 0.5 * (p == neg).mean() for p in pos]))


def brute_curve(scores, labels):
    points = []
    for t in sorted(set(scores)):
        hit = scores >= t
        tp = (hit & (labels == 1)).sum()
        points.append((t, tp / hit.sum(), tp / (labels == 1).sum()))
    return points


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(2)
    scores, labels = rng.integers(0, 40, 600) / 40.0, rng.integers(0, 2, 600)
    return scores, labels, frame(spark, scores, labels).cache()


def test_pr_curve(data):
    scores, labels, df = data
    got = E.pr_curve(df, "score", "label").orderBy(F.asc_nulls_last("threshold")).collect()
    assert (got[-1]["threshold"], got[-1]["precision"], got[-1]["recall"]) == (None, 1.0, 0.0)
    assert np.allclose([tuple(r) for r in got[:-1]], brute_curve(scores, labels))


def test_best_threshold_and_ap_and_auc(data):
    scores, labels, df = data
    points = brute_curve(scores, labels)
    f1 = [2 * p * r / (p + r + 1e-8) for _, p, r in points]
    best = E.best_threshold(df, "score", "label").first()
    assert best["threshold"] == points[int(np.argmax(f1))][0] and abs(best["f1"] - max(f1)) < 1e-12
    ap, previous = 0.0, 0.0
    for _, p, r in reversed(points):
        ap, previous = ap + (r - previous) * p, r
    quality = E.ranking_quality(df, "score", "label").first()
    assert abs(quality["avg_precision"] - ap) < 1e-12
    assert abs(quality["roc_auc"] - brute_auc(scores, labels)) < 1e-12
    roc = sorted((r["fpr"], r["tpr"]) for r in E.roc_curve(df, "score", "label").collect())
    area = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(roc, roc[1:]))
    assert abs(area - quality["roc_auc"]) < 1e-12


def test_ties_take_the_lowest_threshold(spark):
    df = frame(spark, [0.9, 0.8, 0.2, 0.1], [1, 0, 1, 0])
    points = brute_curve(np.array([0.9, 0.8, 0.2, 0.1]), np.array([1, 0, 1, 0]))
    f1 = {t: 2 * p * r / (p + r + 1e-8) for t, p, r in points}
    top = max(f1.values())
    assert E.best_threshold(df, "score", "label").first()["threshold"] == min(t for t, v in f1.items() if v == top)


def test_extremes(spark):
    assert E.roc_auc(frame(spark, [0.1, 0.2, 0.8, 0.9], [0, 0, 1, 1]), "score", "label").first()[0] == 1.0
    assert E.roc_auc(frame(spark, [0.5] * 4, [0, 1, 0, 1]), "score", "label").first()[0] == 0.5
    only_positive = E.ranking_quality(frame(spark, [0.1, 0.9], [1, 1]), "score", "label").first()
    assert only_positive["roc_auc"] is None and only_positive["avg_precision"] == 1.0
    only_negative = E.ranking_quality(frame(spark, [0.1, 0.9], [0, 0]), "score", "label").first()
    assert only_negative["roc_auc"] is None and only_negative["avg_precision"] is None


def test_report_zero_denominators(spark):
    df = spark.createDataFrame([(0, 0), (0, 0)], "predicted int, label int")
    assert E.classification_report(df, "predicted", "label").first().asDict() == {
        "f1_churn": 0.0, "precision_churn": 0.0, "recall_churn": 0.0, "f1_macro": 0.5
    }


def test_report_by_hand(spark):
    rows = [(1, 1)] * 6 + [(1, 0)] * 2 + [(0, 1)] * 3 + [(0, 0)] * 9
    got = E.classification_report(spark.createDataFrame(rows, "predicted int, label int"), "predicted", "label").first()
    assert got["precision_churn"] == 0.75 and got["recall_churn"] == 0.6667 and got["f1_churn"] == 0.7059
    assert got["f1_macro"] == round((12 / 17 + 18 / 23) / 2, 4)
    cells = {(r["actual"], r["predicted"]): r["share"] for r in E.confusion_matrix(spark.createDataFrame(rows, "predicted int, label int"), "predicted", "label").collect()}
    assert abs(cells[(1, 1)] - 6 / 9) < 1e-12 and abs(cells[(0, 1)] - 2 / 11) < 1e-12


def test_calibration_bins_are_right_closed(spark):
    df = frame(spark, [0.0, 0.1, 0.1000001, 1.0], [0, 1, 1, 1])
    got = {r["bin"]: (r["n"], r["mean_label"]) for r in E.calibration_curve(df, "score", "label").collect()}
    assert got == {0: (2, 0.5), 1: (1, 1.0), 9: (1, 1.0)}


def test_comparison_is_sorted(spark):
    rows = [("b", 0.9, 1), ("b", 0.1, 0), ("a", 0.9, 1), ("a", 0.1, 0), ("c", 0.1, 1), ("c", 0.9, 0)]
    df = spark.createDataFrame(rows, "model string, score double, label int")
    table = E.comparison_table(df, E.best_threshold(df, "score", "label", ["model"])).collect()
    assert [r["model"] for r in table] == ["a", "b", "c"] and table[0]["test_auc"] == 1.0 and table[2]["test_auc"] == 0.0
    assert len(table[0]) == 8
