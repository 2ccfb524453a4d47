"""What the physical plans must and must not contain."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from lapsewise import constants as K
from lapsewise.functions.features import FEATURES
from lapsewise.operators.clean import apply_winsor, board_filter
from lapsewise.operators.enrich import engineer_features
from lapsewise.operators.scoring import validate
from lapsewise.operators.split import hash_split
from lapsewise.queries.base import players
from lapsewise.schema import PLAYER_SCHEMA
from lapsewise.sources.tables import read_table
from lapsewise.sources.workspace import new_path

QUERIES = entry.queries()


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [
    "churn_and_engagement_by_mode", "player_profile", "rfm_score", "engineer_features", "segment_profile", "churn_by_mode_vs_overall",
    "recency_overlay", "box_stats", "churn_by_win_rate", "win_rate_trend_line", "davies_bouldin", "cluster_names", "comparison_table",
    "risk_table", "sessionize", "preprocess_matrix", "class_weights",
])
def test_no_cross_joins(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_row_work_needs_no_shuffle(spark):
    spark.createDataFrame([], PLAYER_SCHEMA).write.parquet(path := new_path(spark, "plan"))
    df = spark.read.schema(PLAYER_SCHEMA).parquet(path)
    limits = {c: (0.0, 1.0) for c in K.NUMERIC_FEATURES}
    for out in (engineer_features(apply_winsor(df, limits)), hash_split(df), board_filter(df)):
        text = plan(out)
        assert "Exchange" not in text and "Python" not in text
    assert "Exchange" not in plan(validate(df.selectExpr("to_json(struct(*)) as record")))


def test_unused_features_are_pruned(spark):
    spark.createDataFrame([], PLAYER_SCHEMA).write.parquet(path := new_path(spark, "plan"))
    df = engineer_features(spark.read.schema(PLAYER_SCHEMA).parquet(path)).select("spend_per_session")
    scan = plan(df).split("ReadSchema: ")[1]
    assert "total_spend_usd" in scan and "session_count" in scan and "win_rate" not in scan
    assert len(FEATURES) == 9


def test_filter_reaches_the_scan(spark):
    spark.createDataFrame([], PLAYER_SCHEMA).write.parquet(path := new_path(spark, "plan"))
    text = plan(board_filter(spark.read.schema(PLAYER_SCHEMA).parquet(path), ["PvP"]))
    assert "PushedFilters: [" in text and "In(game_mode_primary" in text or "EqualTo(game_mode_primary" in text


def test_profile_reads_only_what_is_asked(spark, sf_dir):
    text = plan(players(spark, sf_dir, [K.MODE, K.LABEL]))
    assert "lineitem" not in text and "orders.parquet" not in text
    items = plan(players(spark, sf_dir, ["player_id", "win_rate"]))
    schema = [part for part in items.split("ReadSchema: ") if "l_orderkey" in part]
    assert schema and all("l_extendedprice" not in part for part in schema)


def test_item_join_has_partial_aggregation(spark, sf_dir):
    from lapsewise.operators.profile import item_activity

    text = plan(item_activity(read_table(spark, sf_dir, "lineitem"), read_table(spark, sf_dir, "orders")))
    assert "partial_sum" in text


def test_items_are_added_up_in_tasks_of_bounded_rows(spark, monkeypatch):
    """No aggregate runs beside the join, and the tasks that add up follow from the number of items; results as counted by hand."""
    from lapsewise.operators import profile

    monkeypatch.setattr(profile, "ITEM_ROWS", 100)
    orders = spark.createDataFrame([(1, 10), (2, 10), (3, 11), (4, None), (6, 12)], "o_orderkey long, o_custkey long")
    rows = [(1, i % 7, i % 3, 2.0, "R" if i % 4 == 0 else "N") for i in range(100)] + [
        (2, 99, None, None, None), (3, None, 5, 1.5, "R"), (4, 1, 1, 1.0, "N"), (5, 1, 1, 1.0, "N"), (6, None, None, None, None)]
    items = spark.createDataFrame(rows, "l_orderkey long, l_partkey long, l_suppkey long, l_quantity double, l_returnflag string")
    found = profile.item_activity(items, orders)
    text = plan(found)
    assert "Expand" not in text and "REPARTITION_BY_NUM" in text
    got = {r["o_custkey"]: tuple(r)[1:] for r in found.collect()}
    assert got == {10: (200.0, 0.75, 3, 8), 11: (1.5, 0.0, 1, 0), 12: (None, None, 0, 0), None: (1.0, 1.0, 1, 1)}


def test_items_meet_their_orders_in_tasks_of_bounded_rows(spark, monkeypatch):
    """Both sides of the join go to a number of tasks that follows from the items; an order of very many items goes to several."""
    from lapsewise.operators import profile

    monkeypatch.setattr(profile, "ITEM_ROWS", 100)
    rows = [(1, i, i % 5, 1.0, "N") for i in range(700)] + [(i, i, None, 2.0, "R") for i in range(2, 202)] + [(None, 1, 1, 1.0, "N")] * 150
    items = spark.createDataFrame(rows, "l_orderkey long, l_partkey long, l_suppkey long, l_quantity double, l_returnflag string")
    orders = spark.createDataFrame([(1, 10), (1, 11), (2, 10), (3, None), (None, 12)], "o_orderkey long, o_custkey long")
    assert [tuple(r) for r in profile.large_orders(items).collect()] == [(1, 7)]
    assert profile.large_orders(items.limit(0)).count() == 0
    joined = profile.with_owner(items, orders)
    shuffles = [line for line in plan(joined).splitlines() if "Exchange hashpartitioning(l_orderkey" in line]
    assert len(shuffles) == 2 and all(", 11)" in line and "REPARTITION_BY_NUM" in line for line in shuffles)
    assert joined.rdd.glom().map(len).filter(lambda n: n > 0).count() > 3
    got = sorted(joined.groupBy("o_custkey").agg(F.count("*").alias("n"), F.sum("l_quantity").alias("q")).collect(), key=str)
    assert [tuple(r) for r in got] == [(10, 701, 702.0), (11, 700, 700.0), (None, 1, 2.0)]


def test_orders_are_added_up_in_tasks_of_bounded_rows(spark, monkeypatch):
    """Tasks that add orders up follow from their number, not from a file's split, and share a customer of very many; rows by hand."""
    from lapsewise.operators import profile

    monkeypatch.setattr(profile, "ORDER_ROWS", 100)
    rows = [(i, 7, "F" if i > 895 else "O", 1.5, f"2020-01-{1 + i % 28:02d}", "1-URGENT" if i % 2 else "5-LOW") for i in range(900)]
    rows += [(1, 8, "F", None, "2020-01-02", "1-URGENT"), (1, 8, "F", None, "2020-01-02", "1-URGENT"),
             (5, 9, None, 2.0, None, None), (None, 9, "O", 2.0, None, "1-URGENT"), (3, None, "O", 0.1, "2020-02-01", "1-URGENT")]
    orders = spark.createDataFrame(
        rows, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate string, o_orderpriority string"
    ).withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp_ntz"))
    found = profile.order_activity(orders)
    assert any("REPARTITION_BY_NUM" in line and ", 10)" in line for line in plan(found).splitlines())
    got = {r["o_custkey"]: r for r in found.collect()}
    day = lambda v: v and str(v)[:10]
    found = {k: (r["session_count"], day(r["first_seen"]), day(r["last_seen"]), r["spend_cents"],
                 r["last_break"] and (day(r["last_break"][0]), r["last_break"][1])) for k, r in got.items()}
    assert found == {
        7: (900, "2020-01-01", "2020-01-28", 450 * 150, ("2020-01-28", 895)),
        8: (2, "2020-01-02", "2020-01-02", None, None),
        9: (2, None, None, 200, (None, 5)),
        None: (1, "2020-02-01", "2020-02-01", 10, ("2020-02-01", 3)),
    }


def test_players_meet_their_items_in_tasks_of_bounded_rows(spark, sf_dir, monkeypatch):
    """Customers and the sums of their items go to a number of tasks that follows from the customers; the rows stay."""
    from lapsewise.operators import profile

    whole = sorted(map(tuple, players(spark, sf_dir).collect()))
    monkeypatch.setattr(profile, "ITEM_ROWS", 500)
    customers = read_table(spark, sf_dir, "orders").select("o_custkey").distinct().count()
    found = players(spark, sf_dir)
    parts = -(-profile.SPREAD * customers // 500)
    shuffles = [x for x in plan(found).splitlines() if "Exchange hashpartitioning(o_custkey#" in x and f", {parts})" in x]
    assert len(shuffles) == 2 and all("REPARTITION_BY_NUM" in x for x in shuffles)
    assert sorted(map(tuple, found.collect())) == whole
