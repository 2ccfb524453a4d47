"""Cleaning, preprocessing, split."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lapsewise import constants as K
from lapsewise.operators import clean as C
from lapsewise.operators import split as S
from lapsewise.operators.enrich import with_rfm
from lapsewise.plans import stages
from lapsewise.sources import sinks
from lapsewise.sources.tables import load_players, load_splits
from lapsewise.sources.workspace import new_path

N = K.NUMERIC_FEATURES
SCHEMA = (
    "player_id string, session_count bigint, avg_session_duration double, last_login_days_ago bigint, total_playtime_hours double, "
    "win_rate double, total_spend_usd double, friend_count bigint, game_mode_primary string, achievement_count bigint, "
    "consecutive_losses bigint, churn_label int"
)


def make_players(spark, n=800, seed=5):
    rng = np.random.default_rng(seed)

    def maybe(value):
        return None if rng.random() < 0.02 else value

    rows = []
    for i in range(n):
        days = int(rng.integers(0, 180))
        rows.append((
            f"P{i:06d}", int(rng.integers(1, 300)), maybe(float(rng.uniform(5, 240))), days, float(rng.uniform(1, 900)),
            maybe(float(rng.random())), maybe(0.0 if rng.random() < 0.4 else float(rng.gamma(1, 60))), maybe(int(rng.integers(0, 60))),
            str(rng.choice(K.GAME_MODES)), int(rng.integers(0, 300)), int(rng.integers(0, 9)), int(days > 30),
        ))
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def players(spark):
    return make_players(spark).cache()


def test_duplicates_keep_the_first_by_order(spark):
    df = spark.createDataFrame([("a", 3, 30), ("a", 1, 10), ("b", 5, 50), ("a", 2, 20)], "player_id string, seq int, x int")
    got = {r["player_id"]: r["x"] for r in C.remove_duplicates(df, "player_id", "seq").collect()}
    assert got == {"a": 10, "b": 50}
    assert C.duplicate_count(df, "player_id").first().asDict() == {"rows": 4, "kept": 2, "removed": 2}


def test_duplicates_without_order_and_with_ties(spark):
    rows = [("a", None, 5, "x"), ("b", None, 7, "x"), ("b", 2, 9, "y"), ("b", 2, 8, "z"), ("c", None, 3, None), ("c", None, 2, "q"), (None, 1, 1, "n")]
    df = spark.createDataFrame(rows, "k string, seq int, x int, y string")
    got = {tuple(r) for r in C.remove_duplicates(df, "k", "seq").collect()}
    assert got == {("a", None, 5, "x"), ("b", 2, 8, "z"), ("c", None, 2, "q"), (None, 1, 1, "n")}


def test_winsorise(players):
    pdf = players.toPandas()
    limits = C.fit_winsor(players, N)
    out = C.apply_winsor(players, limits).toPandas()
    for c in N:
        lo, hi = pdf[c].quantile(0.01), pdf[c].quantile(0.99)
        want = pdf[c].clip(lo, hi)
        assert np.allclose(out[c].astype(float), want.astype(float), equal_nan=True)
    report = {r["feature"]: r["clipped"] for r in C.winsor_report(players, limits).collect()}
    for c in N:
        lo, hi = limits[c]
        assert report[c] == int(((pdf[c] < lo) | (pdf[c] > hi)).sum())


def test_constant_column_is_skipped(spark):
    df = spark.createDataFrame([(1.0, None), (1.0, 2.0), (1.0, 3.0)], "a double, b double")
    limits = C.fit_winsor(df, ["a", "b"])
    assert "a" not in limits and "b" in limits
    assert C.apply_winsor(df, limits).where("b is null").count() == 1


def test_null_profile_lists_only_columns_with_nulls(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    assert [tuple(r) for r in C.null_profile(df).collect()] == [("b", 1)]


def test_mode_ties_take_the_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,)], "m string")
    assert sorted(r[0] for r in C.impute_mode(df, "m").collect()) == ["a", "a", "a", "b", "b"]


def test_category_guard(spark):
    with pytest.raises(ValueError):
        C.fit_categories(spark.range(2000).select(F.col("id").cast("string").alias("c")), "c")


def test_preprocessor(spark, players):
    prep = C.Preprocessor(N).fit(players)
    assert prep.feature_names[-3:] == ["game_mode_primary_PvE", "game_mode_primary_PvP", "game_mode_primary_Solo"]
    out = prep.transform(players).toPandas()
    pdf = players.toPandas()
    for c in N:
        x = pdf[c].fillna(pdf[c].median())
        assert np.allclose(out[c], (x - x.mean()) / x.std(ddof=0))
    unknown = players.limit(1).withColumn(K.MODE, F.lit("Arcade"))
    row = prep.transform(unknown).first()
    assert [row[c] for c in prep.feature_names[-3:]] == [0.0, 0.0, 0.0]
    again = C.Preprocessor.load(spark, prep.save(spark, new_path(spark, "prep")))
    assert again == prep
    # a zero-variance column is divided by 1
    flat = players.withColumn("win_rate", F.lit(0.5))
    assert C.Preprocessor(["win_rate"]).fit(flat).transform(flat).agg(F.max(F.abs("win_rate"))).first()[0] == 0.0


def test_vectors_put_numerics_first(players):
    prep = C.Preprocessor(N).fit(players)
    row = prep.vectors(players).first()
    assert len(row["features"]) == len(N) + 3
    assert row["features"][0] == row["session_count"]


def test_board_filter(spark):
    df = spark.createDataFrame(
        [("PvP", 0, 0), ("PvP", 1, 3), (None, 0, 1), ("Solo", 0, None)], "game_mode_primary string, churn_label int, monetisation_tier int"
    )
    assert C.board_filter(df).count() == 2
    assert C.board_filter(df, ["PvP"], ["Churned"], ["Whale"]).count() == 1
    assert C.board_filter(df, []).count() == 0


def test_describe(players):
    pdf = players.toPandas()
    got = {r["feature"]: r for r in C.describe(players, N, 4).collect()}
    for c in N:
        d = pdf[c].describe()
        for name, key in [("count", "count"), ("mean", "mean"), ("std", "std"), ("p25", "25%"), ("p50", "50%"), ("p75", "75%")]:
            assert abs(got[c][name] - d[key]) < 1e-3


def test_rfm_score_matches_pandas(players):
    got = with_rfm(players).toPandas().set_index("player_id")
    pdf = players.toPandas().set_index("player_id")
    parts = [pdf["last_login_days_ago"].max() + 1 - pdf["last_login_days_ago"], pdf["session_count"], np.log1p(pdf["total_spend_usd"].fillna(0))]
    want = sum(p.rank(pct=True) * 100 for p in parts) / 3
    assert np.abs(got["rfm_score"] - want).max() <= 0.005 + 1e-9
    assert (got["rfm_score"] > 0).all() and (got["rfm_score"] <= 100).all()


@pytest.mark.parametrize("cut", [S.hash_split, S.exact_split])
def test_splits_are_disjoint_complete_and_stable(players, cut):
    a = {r["player_id"]: r["split"] for r in cut(players).collect()}
    b = {r["player_id"]: r["split"] for r in cut(players.repartition(7)).collect()}
    assert a == b and len(a) == players.count()
    assert S.split_overlap(cut(players)).count() == 0


def test_exact_split_is_stratified(players):
    counts = {(r["split"], r["churn_label"]): r["count"] for r in S.exact_split(players).groupBy("split", "churn_label").count().collect()}
    for label in (0, 1):
        total = sum(v for (_, y), v in counts.items() if y == label)
        for split, share in (("train", 0.7), ("val", 0.15), ("test", 0.15)):
            assert abs(counts[(split, label)] - share * total) <= 1


def test_folds_are_even(players):
    counts = S.with_folds(players, 5).groupBy("churn_label", "fold").count().toPandas()
    for _, part in counts.groupby("churn_label"):
        assert len(part) == 5 and part["count"].max() - part["count"].min() <= 1


def test_class_weights(spark):
    df = spark.createDataFrame([(0,)] * 6 + [(1,)] * 2, "churn_label int")
    assert {r["churn_label"]: round(r["weight"], 6) for r in S.class_weights(df).collect()} == {0: 0.666667, 1: 2.0}
    assert S.with_class_weight(df).count() == 8


def test_split_matrices_fit_on_train_only(players):
    m = stages.split_matrices(stages.enrich(players))
    stats = m.part("train").agg(F.avg("session_count").alias("m"), F.stddev_pop("session_count").alias("s")).first()
    assert abs(stats["m"]) < 1e-9 and abs(stats["s"] - 1) < 1e-9
    assert set(K.ENGINEERED_FEATURES).isdisjoint(m.table.columns)
    assert m.preprocessor.feature_names == [c for c in m.table.columns if c not in ("player_id", "split", "churn_label")]


def test_limits_from_train_only(players):
    rows = S.exact_split(players)
    train = rows.where("split = 'train'").toPandas()
    out = stages.enrich(rows, fit_on="train")
    assert abs(out.agg(F.max("session_count")).first()[0] - train["session_count"].quantile(0.99)) < 1e-9


def test_csv_header_in_another_order_is_an_error(spark, players):
    path = sinks.write_players(players.select(*sorted(players.columns)), new_path(spark, "csv"), "csv")
    with pytest.raises(Exception):
        load_players(spark, path).collect()


def test_nan_is_read_as_null(spark):
    path = new_path(spark, "nan")
    text = "player_id,session_count,avg_session_duration,last_login_days_ago,total_playtime_hours,win_rate,total_spend_usd,friend_count,game_mode_primary,achievement_count,consecutive_losses,churn_label\n"
    spark.createDataFrame([(text + "P1,1,NaN,3,1.0,,2.5,4,PvP,5,0,0",)], "t string").coalesce(1).write.text(path)
    row = load_players(spark, path).first()
    assert row["avg_session_duration"] is None and row["win_rate"] is None and row["total_spend_usd"] == 2.5


def test_one_split_prunes_partitions(spark, players):
    path = sinks.write_splits(S.hash_split(players), new_path(spark, "splits"))
    df = load_splits(spark, path, "val")
    assert "PartitionFilters: [isnotnull(split" in df._jdf.queryExecution().executedPlan().toString()
