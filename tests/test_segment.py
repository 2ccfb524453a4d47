"""Clustering quality and naming."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from test_clean import make_players

from lapsewise import constants as K
from lapsewise.operators import aggregates as A
from lapsewise.operators import segment as S
from lapsewise.operators.enrich import engineer_features
from lapsewise.plans import stages
from lapsewise.sources.workspace import new_path


@pytest.fixture(scope="module")
def blobs(spark):
    rng = np.random.default_rng(9)
    centres = np.array([[0, 0], [6, 0], [0, 6], [6, 6]])
    x = np.concatenate([c + rng.normal(0, 0.6, (50, 2)) for c in centres])
    df = spark.createDataFrame([(f"p{i}", *map(float, v)) for i, v in enumerate(x)], "player_id string, a double, b double")
    return x, df.cache()


def test_kmeans_finds_the_blobs(blobs):
    _, df = blobs
    model = S.fit_kmeans(df, ["a", "b"], 4, restarts=3)
    assert sorted(r["count"] for r in S.assign(df, ["a", "b"], model).groupBy("cluster_id").count().collect()) == [50] * 4
    scan = {r["k"]: r for r in S.scan_k(df, ["a", "b"], range(2, 7), restarts=2).collect()}
    assert [k for k, r in scan.items() if r["best"]] == [4]
    assert scan[2]["inertia"] > scan[4]["inertia"]


def plain_lloyd(x, centres, max_iter=500):
    for _ in range(max_iter):
        near = ((x[:, None] - centres[None]) ** 2).sum(2).argmin(1)
        moved = np.array([x[near == i].mean(0) if (near == i).any() else c for i, c in enumerate(centres)])
        if ((moved - centres) ** 2).sum(1).max() <= S.STAYS**2:
            break
        centres = moved
    return centres, ((x[:, None] - centres[None]) ** 2).sum(2).min(1).sum()


def test_starts_together_equal_plain_loops(spark, blobs):
    """Every start, advanced with the others, ends where it would end alone; the cheapest one wins."""
    x, df = blobs
    names, ks = ["a", "b"], [2, 3, 5]
    got = S.fit_starts(df.repartition(3), names, ks, restarts=4, seed=7)
    sample = np.array([r.x for r in df.select(F.array(*names).alias("x")).orderBy(F.xxhash64("x"), "x").collect()])
    for k in ks:
        alone = [plain_lloyd(x, S.first_centres(sample, k, 7 + turn)) for turn in range(4)]
        centres, cost = min(alone, key=lambda r: r[1])
        assert got[k].cost == pytest.approx(cost) and np.allclose(sorted(map(tuple, got[k].centres)), sorted(map(tuple, centres)), atol=1e-9)


def test_equal_rows_give_fewer_centres(spark):
    df = spark.createDataFrame([(f"p{i}", float(i % 2), 1.0) for i in range(20)], "player_id string, a double, b double")
    model = S.fit_kmeans(df, ["a", "b"], 4, restarts=2)
    assert sorted(map(tuple, model.centres)) == [(0.0, 1.0), (1.0, 1.0)] and model.cost == 0
    with pytest.raises(ValueError):
        S.fit_kmeans(df.limit(0), ["a", "b"])


def brute_silhouette(x, labels):
    out = []
    for i in range(len(x)):
        d = ((x - x[i]) ** 2).sum(axis=1)
        own = labels == labels[i]
        if own.sum() == 1:
            out.append(0.0)
            continue
        a = d[own].sum() / (own.sum() - 1)
        b = min(d[labels == c].mean() for c in set(labels) if c != labels[i])
        out.append((b - a) / max(a, b))
    return np.array(out)


def brute_davies_bouldin(x, labels):
    cs = sorted(set(labels))
    mid = {c: x[labels == c].mean(axis=0) for c in cs}
    s = {c: np.linalg.norm(x[labels == c] - mid[c], axis=1).mean() for c in cs}
    return np.mean([max((s[a] + s[b]) / np.linalg.norm(mid[a] - mid[b]) for b in cs if b != a) for a in cs])


def test_quality_matches_brute_force(spark, blobs):
    x, _ = blobs
    labels = np.arange(200) // 40
    df = spark.createDataFrame([(f"p{i}", int(c), *map(float, v)) for i, (c, v) in enumerate(zip(labels, x))], "player_id string, cluster_id int, a double, b double")
    assert abs(S.davies_bouldin(df, ["a", "b"]).first()[0] - brute_davies_bouldin(x, labels)) < 1e-9
    labels[0] = 9
    df = spark.createDataFrame([(int(c), *map(float, v)) for c, v in zip(labels, x)], "cluster_id int, a double, b double")
    want = brute_silhouette(x, labels)
    got = {r["cluster_id"]: (r["n"], r["silhouette"]) for r in S.silhouette_by_cluster(df, ["a", "b"]).collect()}
    assert set(got) == set(labels)
    for c, (n, value) in got.items():
        assert n == (labels == c).sum() and abs(value - want[labels == c].mean()) < 1e-9


@pytest.mark.parametrize("rows, want", [
    ([(0, 1, 1, 9), (1, 9, 2, 2), (2, 2, 1, 3), (3, 1, 9, 1)], {0: "Champions", 1: "Whales", 2: "Casual", 3: "At-Risk"}),
    # cluster 1 leads in spend and in days: the next by days is At-Risk
    ([(0, 1, 5, 9), (1, 9, 9, 2), (2, 2, 3, 3), (3, 1, 1, 1)], {0: "At-Risk", 1: "Whales", 2: "Champions", 3: "Casual"}),
    # ties take the lowest id
    ([(0, 1, 1, 1), (1, 1, 1, 1), (2, 1, 1, 1), (3, 1, 1, 1)], {0: "Whales", 1: "At-Risk", 2: "Champions", 3: "Casual"}),
])
def test_cluster_names(spark, rows, want):
    df = spark.createDataFrame(rows, "cluster_id int, total_spend_usd int, last_login_days_ago int, session_count int")
    assert {r["cluster_id"]: r["segment"] for r in S.name_clusters(df).collect()} == want


def test_pca(blobs):
    x, df = blobs
    scaled = (x - x.mean(axis=0)) / x.std(axis=0)
    matrix = df.select("player_id", ((F.col("a") - x[:, 0].mean()) / x[:, 0].std()).alias("a"), ((F.col("b") - x[:, 1].mean()) / x[:, 1].std()).alias("b"))
    points, explained = S.project_2d(matrix, ["a", "b"])
    assert abs(explained - 100.0) < 1e-6
    got = points.toPandas()[["PC1", "PC2"]].to_numpy()
    assert np.allclose(sorted(np.var(got, axis=0)), sorted(np.linalg.eigvalsh(np.cov(scaled.T, ddof=0))), atol=1e-9)


def test_whole_step(spark):
    df = engineer_features(stages.enrich(make_players(spark, 400)))
    out, _, features = S.segment_players(df, restarts=2, max_iter=50)
    assert features == K.CLUSTER_FEATURES and out.count() == 400
    assert {r[0] for r in out.select("segment").distinct().collect()} == set(K.SEGMENTS)
    profile = A.segment_profile(out)
    assert profile.count() == 4 and profile.where("retention_strategy is null").count() == 0
    radar = A.segment_radar(profile).groupBy("metric").agg(F.max("value").alias("v")).collect()
    assert len(radar) == 6 and all(abs(r["v"] - 1) < 1e-6 for r in radar)


def test_missing_columns_are_skipped(spark):
    df = spark.createDataFrame([("a", 1, 2.0), ("b", 3, None)], "player_id string, session_count int, win_rate double")
    matrix, have = S.cluster_matrix(df)
    assert have == ["session_count", "win_rate"]
    assert [r["win_rate"] for r in matrix.collect()] == [0.0, 0.0]


def test_cards_keep_empty_segments(spark):
    df = spark.createDataFrame([("Whales", 1, 90.0), ("Whales", 0, None)], "segment string, churn_label int, total_spend_usd double")
    cards = {r["segment"]: r for r in A.segment_cards(df).collect()}
    assert set(cards) == set(K.SEGMENTS) and cards["Casual"]["players"] == 0
    assert cards["Whales"]["churn_pct"] == 50.0 and cards["Whales"]["avg_spend"] == 45.0


def test_stored_segmenter_assigns_new_players(spark):
    df = engineer_features(stages.enrich(make_players(spark, 300)))
    fitted = S.fit_segmenter(df, restarts=1, max_iter=20)
    loaded = S.Segmenter.load(spark, fitted.save(spark, new_path(spark, "segmenter")))
    assert (loaded.features, loaded.medians, loaded.scales, loaded.names) == (fitted.features, fitted.medians, fitted.scales, fitted.names)
    some = df.limit(20).withColumn("session_count", F.lit(None).cast("double"))
    rows = loaded.segments(some).collect()
    assert len(rows) == 20 and {r["segment"] for r in rows} <= set(K.SEGMENTS)


def test_sums_by_nearest_centre_of_a_batch():
    x = np.random.default_rng(2).normal(size=(3000, 3))
    starts = [x[:2].copy(), x[5:9].copy()]
    batch = pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array(np.arange(3001) * 3, pa.int32()), pa.array(x.ravel()))], names=["x"])
    (out,) = S.nearest_sums(starts, iter([batch.slice(0, 1700), batch.slice(1700)]))
    at = 0
    for centres in starts:
        near = ((x[:, None] - centres[None]) ** 2).sum(2).argmin(1)
        for i in range(len(centres)):
            assert out.column("n")[at].as_py() == (near == i).sum()
            assert np.allclose(out.column("sums")[at].as_py(), x[near == i].sum(0))
            at += 1
