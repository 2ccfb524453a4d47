"""Bracketed quantiles equal numpy's, and no value is shuffled."""

import numpy as np
import pytest

from lapsewise.operators import brackets as B
from lapsewise.operators import ranks as X
from lapsewise.sources.workspace import new_path

FRACTIONS = [0.0, 0.01, 0.25, 0.5, 0.99, 1.0]


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(5)
    n = 40_000
    heavy = np.where(rng.random(n) < 0.6, 7.0, rng.normal(0, 50, n).round(1))
    data = {"g": rng.integers(0, 3, n), "smooth": rng.normal(0, 1, n), "heavy": heavy, "two": rng.integers(0, 2, n).astype(float)}
    path = new_path(spark, "numbers")
    columns = list(data)
    table = [tuple(v.item() for v in r) for r in zip(*data.values())]
    spark.createDataFrame(table, "g int, smooth double, heavy double, two double").repartition(4).write.parquet(path)
    return {c: data[c] for c in columns}, spark.read.parquet(path)


@pytest.mark.parametrize("few", [0, 50, B.FEW])
def test_equal_numpy(rows, few):
    """Also if nothing is ever collected and each rank has to end on a cut."""
    data, df = rows
    got = B.find_quantiles(df, ["smooth", "heavy", "two"], FRACTIONS, few=few)
    for c in ("smooth", "heavy", "two"):
        assert np.allclose([got[(c,)][q] for q in FRACTIONS], np.quantile(data[c], FRACTIONS), rtol=0, atol=1e-12)


def test_groups_equal_the_ranked_form(rows):
    data, df = rows
    key = lambda r: (r["g"], r["feature"], r["fraction"])
    got = {key(r): r["quantile"] for r in B.quantile_rows(df, ["smooth", "heavy"], [0.25, 0.5], ["g"]).collect()}
    want = {key(r): r["quantile"] for r in X.quantiles(df, ["smooth", "heavy"], [0.25, 0.5], ["g"]).collect()}
    assert got.keys() == want.keys() and len(got) == 12
    assert all(abs(got[k] - want[k]) < 1e-12 for k in got)


def test_bad_sketch_costs_only_rounds(rows, monkeypatch):
    """Every rank is looked for at the wrong end of the sketch."""
    data, df = rows
    true_cut = B.Ranks.cut
    monkeypatch.setattr(B.Ranks, "cut", lambda self, slot, low, high, grid: true_cut(self, slot, low, high, grid and sorted(grid, reverse=True)))
    got = B.find_quantiles(df, ["smooth"], [0.1, 0.5])
    assert np.allclose(list(got[("smooth",)].values()), np.quantile(data["smooth"], [0.1, 0.5]), rtol=0, atol=1e-12)


def test_nulls_nan_and_groups_of_null(spark):
    nan = float("nan")
    rows = [(None, 1.0), (None, 3.0), (1, nan), (1, 5.0), (1, None), (2, None)]
    df = spark.createDataFrame(rows, "g int, x double")
    for few in (0, 100):
        got = B.find_quantiles(df, ["x"], [0.0, 0.5, 1.0], ["g"], few)
        assert set(got) == {(None, "x"), (1, "x")}
        assert got[(None, "x")] == {0.0: 1.0, 0.5: 2.0, 1.0: 3.0}
        assert got[(1, "x")][0.0] == 5.0 and np.isnan(got[(1, "x")][1.0])


def test_empty_and_one_row(spark):
    df = spark.createDataFrame([(None,)], "x double")
    assert B.collect_quantiles(df, ["x"], [0.5]) == {"x": {}}
    assert B.quantile_rows(df, ["x"], [0.5]).collect() == []
    assert B.collect_quantiles(spark.createDataFrame([(-0.0,)], "x double"), ["x"], [0.5]) == {"x": {0.5: 0.0}}


def test_collected_values_do_not_grow_with_the_rows(rows, spark, monkeypatch):
    """Four times the rows: as many intervals are searched, and none with more than the bound is collected."""
    data, df = rows
    sizes = []
    true_collected = B.Ranks.collected
    monkeypatch.setattr(B.Ranks, "collected", lambda self, slot, values: (sizes.append(len(values)), true_collected(self, slot, values)))
    big = df.unionByName(df).unionByName(df).unionByName(df)
    for table in (df, big):
        B.find_quantiles(table, ["smooth"], [0.5], few=1000)
    assert 1 <= len(sizes) <= 4 and max(sizes) <= 1000


def test_values_meet_their_intervals_without_a_shuffle(rows, spark, monkeypatch):
    """The list of intervals goes to the values, also of a large table; its few keys don't gather the values in as many tasks."""
    _, df = rows
    plans, kind, true_collect = [], type(df), type(df).collect

    def collect(self):
        found = true_collect(self)
        plans.append(self._jdf.queryExecution().executedPlan().toString())
        return found

    monkeypatch.setattr(kind, "collect", collect)
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")  # a small table would be broadcast itself
    try:
        B.find_quantiles(df, ["smooth", "heavy"], [0.5], ["g"], few=50)
    finally:
        spark.conf.set(name, before)
    joins = [text for text in plans if "Join" in text]
    assert joins and all("BroadcastHashJoin" in text for text in joins)
    assert not any("SortMergeJoin" in text or "hashpartitioning(coalesce(" in text for text in joins)
