"""Running totals, ranks, quantiles and the skew-proof join against pandas and numpy."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lapsewise.operators import brackets as B
from lapsewise.operators import ranks as X
from lapsewise.operators.joins import join_lookup, with_overall
from lapsewise.operators.profile import loss_streak
from lapsewise.sources.workspace import materialise


@pytest.fixture(scope="module")
def numbers():
    rng = np.random.default_rng(7)
    spend = np.where(rng.random(5000) < 0.4, 0.0, rng.gamma(1.0, 40.0, 5000).round(2))
    spend[rng.random(5000) < 0.02] = np.nan
    return pd.DataFrame({
        "player_id": [f"P{i:06d}" for i in range(5000)],
        "spend": spend,
        "sessions": rng.integers(1, 40, 5000).astype(float),
        "label": rng.integers(0, 2, 5000),
    })


@pytest.fixture(scope="module")
def table(spark, numbers):
    clean = pd.DataFrame({c: pd.Series(numbers[c].tolist(), dtype=object) for c in numbers}).where(numbers.notna(), None)
    return spark.createDataFrame(list(clean.itertuples(index=False)), "player_id string, spend double, sessions double, label int")


@pytest.mark.parametrize("ranges", [1, 7])
@pytest.mark.parametrize("descending", [False, True])
def test_running_totals(table, numbers, ranges, descending):
    rows = table.select("label", F.coalesce("spend", F.lit(0.0)).alias("value"))
    placed = X.collapse(rows, "value", ["label"], {"amount": F.col("value")}, ranges)
    got = X.running_totals(placed, "value", ["n", "amount"], ["label"], descending).toPandas()
    pdf = numbers.assign(value=numbers["spend"].fillna(0)).groupby(["label", "value"]).size().rename("n").reset_index()
    pdf = pdf.sort_values(["label", "value"], ascending=[True, not descending])
    pdf["cum_n"] = pdf.groupby("label")["n"].cumsum()
    pdf["total_n"] = pdf.groupby("label")["n"].transform("sum")
    both = got.merge(pdf, on=["label", "value"], suffixes=("", "_want"))
    assert len(both) == len(pdf) == len(got)
    assert (both["cum_n"] == both["cum_n_want"]).all() and (both["total_n"] == both["total_n_want"]).all()


def test_no_value_spans_two_ranges(table):
    placed = X.collapse(table.select("sessions"), "sessions", ranges=6)
    spans = placed.groupBy("_range").agg(F.min("sessions").alias("a"), F.max("sessions").alias("b")).orderBy("a").collect()
    assert len(spans) > 1
    assert all(x["b"] < y["a"] for x, y in zip(spans, spans[1:]))


def test_quantiles_match_numpy(table, numbers):
    fractions = [0.0, 0.01, 0.25, 0.5, 0.98, 0.99, 1.0]
    got = B.collect_quantiles(table, ["spend", "sessions"], fractions)
    for column in ("spend", "sessions"):
        want = np.quantile(numbers[column].dropna(), fractions)
        assert np.allclose([got[column][q] for q in fractions], want, rtol=0, atol=1e-12)


def test_quantiles_by_group(table, numbers):
    got = {(r["label"], r["fraction"]): r["quantile"] for r in X.quantiles(table, ["spend"], [0.3, 0.5], ["label"]).collect()}
    for label, part in numbers.groupby("label"):
        for q in (0.3, 0.5):
            assert abs(got[(label, q)] - np.quantile(part["spend"].dropna(), q)) < 1e-12


def test_small_golden_sets(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("c", 2.0), ("d", 5.0), ("e", 9.0), ("f", None)], "player_id string, x double")
    assert abs(B.collect_quantiles(df, ["x"], [0.99])["x"][0.99] - 8.84) < 1e-12
    ranked = X.with_rank_pct(df, {"x": "pct"}, "player_id").orderBy("player_id").collect()
    assert [r["pct"] for r in ranked] == [0.2, 0.5, 0.5, 0.8, 1.0, None]


def test_empty_input(spark):
    df = spark.createDataFrame([], "player_id string, x double")
    assert B.collect_quantiles(df, ["x"], [0.5]) == {"x": {}}
    assert X.with_rank_pct(df, {"x": "pct"}, "player_id").count() == 0
    assert X.ecdf(df, "x").count() == 0


@pytest.mark.parametrize("options", [{}, {"hot_rows": 100}])
def test_rank_pct_matches_pandas(table, numbers, options):
    got = X.with_rank_pct(table, {"spend": "a", "sessions": "b"}, "player_id", **options).toPandas()
    both = got.merge(numbers.assign(wa=numbers["spend"].rank(pct=True), wb=numbers["sessions"].rank(pct=True)), on="player_id")
    assert len(both) == 5000
    assert np.allclose(both["a"].astype(float), both["wa"], equal_nan=True, atol=1e-12)
    assert np.allclose(both["b"], both["wb"], atol=1e-12)


def test_hot_key_join_splits_and_loses_nothing(spark):
    big = spark.range(9000).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, F.lit(1)).when(F.col("id") % 7 == 0, F.lit(None)).otherwise(F.col("id")).cast("bigint").alias("k")
    )
    lookup = materialise(big.where("k is not null").groupBy("k").agg(F.count(F.lit(1)).alias("w"), (F.max("k") * 2).alias("v")))
    joined = join_lookup(big, lookup, ["k"], "w", ["id"], hot_rows=200)
    plain = join_lookup(big, lookup, ["k"], "w", ["id"])
    key = lambda r: r["id"]
    assert sorted(joined.select("id", "k", "v").collect(), key=key) == sorted(plain.select("id", "k", "v").collect(), key=key)


def test_loss_streak_with_hot_key(spark):
    rng = np.random.default_rng(3)
    rows = [(1 if rng.random() < 0.4 else int(rng.integers(2, 60)), i, bool(rng.random() < 0.7) if rng.random() > 0.05 else None) for i in range(3000)]
    rows += [(99, 5000 + i, True) for i in range(4)] + [(98, 6000, False)]
    df = spark.createDataFrame(rows, "k int, t bigint, lost boolean")
    want = {}
    for k, _, lost in sorted(rows, key=lambda r: r[1]):
        want[k] = want.get(k, 0) + 1 if lost else 0
    for options in ({}, {"hot_rows": 50}):
        got = {r["k"]: r["streak"] for r in loss_streak(df, "k", ["t"], F.col("lost"), **options).collect()}
        assert got == want


def test_ecdf_and_pareto(table, numbers):
    filled = numbers["spend"].fillna(0)
    cdf = X.ecdf(table, "spend").toPandas().sort_values("value")
    assert cdf["cdf"].iloc[-1] == 1.0
    zero = cdf[cdf["value"] == 0.0]["cdf"].iloc[0]
    assert abs(zero - (filled == 0).mean()) < 1e-12
    top = X.top_share(table, "spend", 0.2).first()
    want = filled.sort_values(ascending=False).iloc[:1000].sum() / filled.sum()
    assert top["top_players"] == 1000 and abs(top["revenue_share"] - want) < 1e-12
    curve = X.pareto(table, "spend").toPandas().sort_values("value", ascending=False)
    assert abs(curve["cum_share"].iloc[-1] - 1.0) < 1e-12 and curve["cum_n"].iloc[-1] == 5000


def test_pareto_of_nothing_spent(spark):
    df = spark.createDataFrame([(0.0,), (None,)], "x double")
    assert [r["cum_share"] for r in X.pareto(df, "x").collect()] == [None]


def test_sample_is_stable_and_exact(table):
    a = {r["player_id"] for r in X.seeded_sample(table, "player_id", 100).collect()}
    b = {r["player_id"] for r in X.seeded_sample(table.repartition(5), "player_id", 100).collect()}
    assert len(a) == 100 and a == b


def test_sample_by_threshold(spark, table):
    """No task gathers the sample; repeated and null keys, more rows than asked for, and fewer."""
    plan = X.seeded_sample(table, "player_id", 100)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "TakeOrdered" not in plan and "Exchange" not in plan
    rows = spark.range(9000).selectExpr("IF(id % 3 = 0, null, IF(id % 3 = 1, 'hot', CAST(id AS STRING))) AS id", "id AS x")
    for n in (0, 1, 2999, 3001, 5000, 9000, 20000):
        got = X.seeded_sample(rows, "id", n).collect()
        assert len(got) == min(n, 9000) == len({r["x"] for r in got})


def test_nth_smallest_goes_down_to_single_digits(spark):
    rows = spark.range(500).selectExpr("lpad(lower(hex(id)), 8, '0') AS h")
    assert [X.nth_smallest(rows, "h", n, 1, 1) for n in (1, 17, 500, 501)] == ["00000000", "00000010", "000001f3", None]


def test_scalar_statistics(table):
    stats = table.agg(F.max("sessions").alias("top"))
    out = with_overall(table, stats, {"top": "top"})
    assert out.select("top").distinct().count() == 1
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_every_window_has_a_real_key(table):
    ranked = X.rank_table(X.collapse(X.unpivot_numeric(table, ["spend", "sessions"]), "value", ["feature"]))
    plan = ranked._jdf.queryExecution().optimizedPlan().toString()
    assert "_range" in plan and "Window" in plan
    assert all("feature" in line for line in plan.splitlines() if "Window" in line)
