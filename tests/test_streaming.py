"""Streams give the batch result; late rows are dropped and counted."""

import datetime as dt
import json

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_scoring import CASES

from lapsewise.operators import activity as B
from lapsewise.operators import scoring as V
from lapsewise.schema import EVENT_SCHEMA
from lapsewise.sources.workspace import new_path
from lapsewise.streaming import activity as T
from lapsewise.streaming.scoring import read_records, rejected_stream

START = dt.datetime(2024, 1, 1)


def events(spark, rows):
    return spark.createDataFrame([(i, t, u, "view", 1.0, "{}") for i, (u, t) in enumerate(rows)], EVENT_SCHEMA)


@pytest.fixture(scope="module")
def many(spark):
    rng = np.random.default_rng(11)
    rows = []
    for _ in range(4000):
        user = 1 if rng.random() < 0.4 else int(rng.integers(2, 30))
        rows.append((user, START + dt.timedelta(seconds=float(rng.uniform(0, 15 * 86400)))))
    return rows, events(spark, rows).cache()


def brute_sessions(rows, gap):
    out, by = [], {}
    for u, t in sorted(rows):
        if u in by and t - by[u][1] <= gap:
            by[u][1], by[u][2] = t, by[u][2] + 1
        else:
            if u in by:
                out.append((u, *by[u]))
            by[u] = [t, t, 1]
    return sorted(out + [(u, *v) for u, v in by.items()])


@pytest.mark.parametrize("gap, chunk", [(30, None), (30, 60), (30, 10), (240, 60), (1, 1440), (0, 60)])
def test_sessions_match_brute_force(many, gap, chunk):
    rows, df = many
    got = B.sessionize(df, "user_id", "ts", gap, chunk).collect()
    want = brute_sessions(rows, dt.timedelta(minutes=gap))
    key = lambda r: (r[0], r[1].replace(tzinfo=None), r[2].replace(tzinfo=None), r[3])
    assert sorted(map(key, got)) == want


def test_gap_equal_to_the_limit_continues(spark):
    t = [START + dt.timedelta(minutes=m) for m in (0, 30, 61)]
    got = B.sessionize(events(spark, [(1, x) for x in t]), "user_id", "ts", 30).collect()
    assert sorted(r["events"] for r in got) == [1, 2]


def test_hot_user_is_added_up_before_the_windows(spark):
    """300 000 events of one user in one hour; before 1970 too, where division rounds the other way."""
    for start in ("2024-01-01", "1969-12-31 23:30:00"):
        rows = spark.range(0, 300_000, 1, 6).selectExpr("7L AS user_id", f"timestampadd(microsecond, id * 12000, timestamp_ntz'{start}') AS ts")
        pieces = rows.select("user_id", B.micros(F.col("ts")).alias("first"))
        pieces = pieces.withColumn("last", F.col("first")).withColumn("events", F.lit(1))
        assert B.cells(pieces, "user_id", 60_000_000).count() in (60, 61)
        (only,) = B.sessionize(rows, "user_id", "ts", 1).collect()
        assert only["events"] == 300_000


def test_rolling_activity(many):
    rows, df = many
    days = {}
    for u, t in rows:
        days[(u, t.date())] = days.get((u, t.date()), 0) + 1
    for r in B.rolling_activity(df, "user_id", "ts").collect():
        want = sum(days.get((r["user_id"], r["day"] - dt.timedelta(days=i)), 0) for i in range(7))
        assert r["trailing"] == want


def run(spark, stream, name):
    out = new_path(spark, name)
    query = T.start_file_sink(stream, out, new_path(spark, f"{name}-progress"))
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out), query


def test_stream_equals_batch(spark, many):
    rows, df = many
    folder = new_path(spark, "events")
    df.repartition(3).write.parquet(folder)
    mark = max(t for _, t in rows) - dt.timedelta(days=2)
    daily, _ = run(spark, T.flat_daily(T.daily_counts(T.read_events(spark, folder))), "daily")
    batch = {(r["user_id"], r["day"]): r["events"] for r in B.rolling_activity(df, "user_id", "ts").collect()}
    closed = {k: v for k, v in batch.items() if dt.datetime.combine(k[1], dt.time()) + dt.timedelta(days=1) <= mark}
    assert {(r["user_id"], r["day_start"].date()): r["events"] for r in daily.collect()} == closed
    trailing = {(r["user_id"], r["day"]): r["trailing"] for r in B.rolling_activity(df, "user_id", "ts").collect()}
    weekly, _ = run(spark, T.weekly_counts(T.read_events(spark, folder)), "weekly")
    rows_out = weekly.collect()
    seen = {(r["user_id"], r["last_day"]): r["trailing"] for r in rows_out}
    assert len(seen) == len(rows_out) > 0
    shared = [k for k in seen if k in trailing]
    assert shared and all(seen[k] == trailing[k] for k in shared)
    sessions, _ = run(spark, T.session_counts(T.read_events(spark, folder), gap="30 minutes"), "sessions")
    want = {(r["user_id"], r["session_start"], r["session_end"], r["events"]) for r in B.sessionize(df, "user_id", "ts", 30).collect()}
    want = {w for w in want if w[2].replace(tzinfo=None) + dt.timedelta(minutes=30) <= mark}
    assert {tuple(r) for r in sessions.collect()} == want


def test_merged_batches_equal_batch(spark, many):
    """Several micro-batches in arbitrary order, a repeated one, and events far behind the latest."""
    rows, df = many
    folder, out, progress = (new_path(spark, n) for n in ("events", "merged", "merged-progress"))
    df.repartition(4).write.parquet(folder)
    stream = T.read_events(spark, folder, per_trigger=1)
    T.start_partial_sink(stream, out, progress).awaitTermination()
    T.start_partial_sink(stream, out, new_path(spark, "again")).awaitTermination()
    want = {(r["user_id"], r["day"]): (r["events"], r["trailing"]) for r in B.rolling_activity(df, "user_id", "ts").collect()}
    assert {(r["user_id"], r["day"]): r["events"] for r in T.merged_days(spark, out).collect()} == {k: v[0] for k, v in want.items()}
    weeks = {(r["user_id"], r["last_day"]): r["trailing"] for r in T.merged_weeks(spark, out).collect()}
    assert all(weeks[k] == v[1] for k, v in want.items())
    found = {(r["user_id"], r["session_start"], r["session_end"], r["events"]) for r in T.merged_sessions(spark, out).collect()}
    assert found == {(r["user_id"], r["session_start"], r["session_end"], r["events"]) for r in B.sessionize(df, "user_id", "ts", 30).collect()}


def test_late_rows_are_dropped_and_counted(spark):
    folder = new_path(spark, "late")
    day = lambda d: START + dt.timedelta(days=d)
    events(spark, [(1, day(0)), (1, day(10))]).coalesce(1).write.parquet(folder)
    stream = T.flat_daily(T.daily_counts(T.read_events(spark, folder)))
    out, progress = new_path(spark, "out"), new_path(spark, "progress")
    T.start_file_sink(stream, out, progress).awaitTermination()
    # the watermark is day 8 now: day 1 is late, day 9 is not
    events(spark, [(1, day(1)), (1, day(9)), (1, day(20))]).coalesce(1).write.mode("append").parquet(folder)
    second = T.start_file_sink(stream, out, progress)
    second.awaitTermination()
    assert T.late_rows(second) == 1
    days = sorted(r["day_start"].replace(tzinfo=None) for r in spark.read.schema(stream.schema).parquet(out).collect())
    assert days == [day(0), day(9), day(10)]


def test_rejected_records(spark):
    folder = new_path(spark, "records")
    texts = [json.dumps(r) for r, _ in CASES] + ["not json", ""]
    spark.createDataFrame([(t,) for t in texts], "value string").repartition(2).write.text(folder)
    out, _ = run(spark, rejected_stream(read_records(spark, folder)), "rejected")
    batch = V.validate(spark.createDataFrame([(t,) for t in texts if t], "record string")).where(~V.is_valid())
    assert sorted((r["record"], *r["errors"]) for r in out.collect()) == sorted((r["record"], *r["errors"]) for r in batch.collect())
    assert out.where(F.col("record") == "not json").count() == 1
