"""Edge cases of the reports that whole-table comparison does not reach."""

from pyspark.sql import functions as F

from lapsewise import constants as K
from lapsewise.operators import aggregates as A
from lapsewise.operators.clean import with_display_columns


def test_friend_bins_keep_empty_ones(spark):
    values = [None, 0, 2, 3, 5, 6, 10, 21, 50, 51, 201]
    df = spark.createDataFrame([(v, i % 2) for i, v in enumerate(values)], "friend_count int, churn_label int")
    got = {r["friend_bin"]: (r["n"], r["churn_pct"]) for r in A.churn_by_friends(df).collect()}
    assert list(sorted(got)) == sorted(K.FRIEND_BINS[1])
    assert got["0"] == (2, 50.0) and got["11-20"] == (0, None) and got["50+"][0] == 2


def test_loss_pivot_has_every_column(spark):
    df = spark.createDataFrame([("PvP", 0, 1), ("PvP", 0, 0), ("Solo", 7, 1)], "game_mode_primary string, consecutive_losses int, churn_label int")
    got = {r["game_mode"]: r for r in A.churn_mode_by_losses(df).collect()}
    assert A.churn_mode_by_losses(df).columns == ["game_mode", *K.LOSS_BINS[1]]
    assert got["PvP"]["0"] == 50.0 and got["PvP"]["11+"] is None and got["Solo"]["7-10"] == 100.0


def test_nobody_is_beyond_the_last_bin(spark):
    df = spark.createDataFrame([("PvP", 16, 1, 201, 2e9), ("PvP", 100, 0, 10_000, 5.0)], "game_mode_primary string, consecutive_losses int, churn_label int, friend_count int, total_spend_usd double")
    assert A.churn_mode_by_losses(df).first()["11+"] == 50.0
    assert {r["friend_bin"]: r["n"] for r in A.churn_by_friends(df).collect()}["50+"] == 2
    tiers = {r["tier"]: r["players"] for r in A.spend_tier_counts(with_display_columns(df)).collect()}
    assert tiers == {"Whale": 1, "Minnow": 1}


def test_every_month_is_a_cohort(spark):
    df = spark.range(40).selectExpr("add_months(date'2020-01-15', cast(id as int)) AS join_date", "0 AS churn_label")
    assert A.cohort_retention(df).count() == 40 and A.cohort_retention(df, 12).count() == 12


def test_funnel_stages_are_independent(spark):
    df = spark.createDataFrame([(1, 50, 5.0), (9, 0, None), (5, 10, 10.0)], "session_count int, achievement_count int, total_spend_usd double")
    got = {r["stage"]: (r["players"], r["pct"]) for r in A.engagement_funnel(df).collect()}
    assert got == {"All Players": (3, 100.0), "5+ Sessions": (2, 66.7), "10+ Achievements": (2, 66.7), "First Purchase": (2, 66.7), "Spent $10+": (1, 33.3)}


def test_histogram_counts_everything(spark):
    df = spark.range(1000).select((F.col("id") % 2).cast("int").alias("churn_label"), (F.col("id") % 97).alias("x"))
    got = A.histogram(df, F.col("x"), 10).collect()
    assert sum(r["n"] for r in got) == 1000 and max(r["bin"] for r in got) == 9
    for label in (0, 1):
        assert abs(sum(r["density"] * (r["high"] - r["low"]) for r in got if r["label"] == label) - 1) < 1e-9
    flat = spark.createDataFrame([(0, 5.0), (0, 5.0)], "churn_label int, x double")
    assert [(r["bin"], r["n"], r["density"]) for r in A.histogram(flat, F.col("x"), 10).collect()] == [(0, 2, None)]


def test_box_outliers(spark):
    rows = [(0, float(v)) for v in [1, 2, 3, 4, 5, 6, 7, 8, 9, 100]]
    df = spark.createDataFrame(rows, "churn_label int, x double")
    r = A.box_stats(df, ["x"], cap=1.0).first()
    assert (r["q1"], r["median"], r["q3"], r["whisker_low"], r["whisker_high"], r["outliers"]) == (3.25, 5.5, 7.75, 1.0, 9.0, 1)


def test_quadratic_is_recovered(spark):
    df = spark.createDataFrame([(x / 10, 3 * (x / 10) ** 2 - 2 * (x / 10) + 7) for x in range(10)], "x double, y double")
    r = A.quadratic_trend(df, "x", "y").first()
    assert [round(v, 9) for v in r] == [3.0, -2.0, 7.0]


def test_correlation_skips_incomplete_pairs(spark):
    df = spark.createDataFrame([(1.0, 2.0, None), (2.0, 4.0, 1.0), (3.0, None, 0.0), (4.0, 8.0, 5.0)], "a double, b double, c double")
    got = {(r["row_feature"], r["col_feature"]): r["corr"] for r in A.correlation_pairs(df, ["a", "b", "c"]).collect()}
    assert len(got) == 3 and abs(got[("b", "a")] - 1.0) < 1e-12


def test_null_modes_are_dropped(spark):
    df = spark.createDataFrame([(None, 1), ("PvP", 1), ("PvP", 0)], "game_mode_primary string, churn_label int")
    rows = A.churn_by_mode_vs_overall(df).collect()
    assert len(rows) == 1 and rows[0]["churn_pct"] == 50.0 and rows[0]["above_overall"] is False


def test_cube_answers_every_filter(spark):
    """KPI row, churn by mode and tier counts read from the cube equal those of the filtered players."""
    modes, spends = ["PvP", "Solo", "Co-op", None], [0.0, 5.0, 50.0, 500.0, None]
    rows = [(modes[i % 4], spends[i % 5], None if i % 11 == 0 else float(i % 17), None if i % 13 == 0 else int(i % 3 == 0)) for i in range(400)]
    df = with_display_columns(spark.createDataFrame(rows, "game_mode_primary string, total_spend_usd double, session_count double, churn_label int"))
    cube = A.kpi_cube(df).cache()
    assert {r["level"] for r in cube.select("level").distinct().collect()} == set(range(8))
    names = {"game_mode": K.MODE, "spend_tier": "spend_tier_label", "status": "churn_risk_level"}
    statuses = [r[0] for r in df.select("churn_risk_level").where("churn_risk_level IS NOT NULL").distinct().collect()]
    for chosen in [{}, {"game_mode": ["PvP", "Solo"]}, {"spend_tier": ["Whale"], "status": statuses[:1]}, {"game_mode": ["Co-op"], "spend_tier": ["Free", "Minnow"], "status": statuses}, {"game_mode": ["none"]}]:
        part = df
        for name, values in chosen.items():
            part = part.where(F.col(names[name]).isin(values))
        for own, direct in [(A.kpi_row_from_cube, A.kpi_row), (A.churn_by_mode_from_cube, A.churn_by_mode), (A.spend_tier_counts_from_cube, A.spend_tier_counts)]:
            assert sorted(map(tuple, own(cube, **chosen).collect())) == sorted(map(tuple, direct(part).collect())), (chosen, own)
    assert A.kpi_cube(df.limit(0)).where("level < 7").count() == 0
