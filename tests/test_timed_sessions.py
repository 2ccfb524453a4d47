"""Timed sessions: closed and open ones equal the batch, late events are counted, a restart goes on."""

import datetime as dt

import numpy as np
import pytest
from test_streaming import START, brute_sessions, events

from lapsewise.operators import activity as B
from lapsewise.sources.workspace import new_path
from lapsewise.streaming import sessions as S
from lapsewise.streaming.activity import read_events

GAP = dt.timedelta(minutes=30)


def tuples(df):
    return sorted((r["user_id"], r["session_start"].replace(tzinfo=None), r["session_end"].replace(tzinfo=None), r["events"]) for r in df.collect())


def append(spark, folder, rows):
    events(spark, rows).coalesce(1).write.mode("append").parquet(folder)


def go(spark, folder, out, progress, **options):
    stream = S.timed_sessions(read_events(spark, folder), **options)
    S.start_timed_sessions(stream, out, progress).awaitTermination()
    return S.recorded(spark, out, stream.schema)


def test_closed_and_open_equal_batch(spark):
    """Three runs from one checkpoint; out of order inside the delay, a hot user."""
    rng = np.random.default_rng(3)
    folder, out, progress = (new_path(spark, n) for n in ("events", "timed", "timed-progress"))
    rows = []
    for day in range(3):
        part = []
        for _ in range(1500):
            user = 1 if rng.random() < 0.4 else int(rng.integers(2, 20))
            # reaches a day back, which is inside the delay
            part.append((user, START + dt.timedelta(days=day) + dt.timedelta(microseconds=int(rng.integers(0, 2 * 86_400_000_000)))))
        rows += part
        append(spark, folder, part)
        found = go(spark, folder, out, progress)
        closed, still_open = tuples(found.where("kind = 'session'")), tuples(S.open_sessions(spark, progress))
        assert sorted(closed + still_open) == brute_sessions(rows, GAP)
        assert found.where("kind = 'late'").count() == 0
    mark = max(t for _, t in rows) - dt.timedelta(days=2)
    assert closed and all(end + GAP <= mark for _, _, end, _ in closed)
    assert still_open and all(end + GAP + dt.timedelta(minutes=2) > mark for _, _, end, _ in still_open)
    assert tuples(B.sessionize(events(spark, rows), "user_id", "ts", 30)) == sorted(closed + still_open)


def test_late_events_come_out_apart(spark):
    folder, out, progress = (new_path(spark, n) for n in ("events", "late", "late-progress"))
    day = lambda d: START + dt.timedelta(days=d)
    append(spark, folder, [(1, day(0)), (2, day(10)), (None, day(3))])
    go(spark, folder, out, progress)
    # the watermark is day 8: user 1 is closed, three events are late, day 9 is not
    append(spark, folder, [(1, day(0)), (1, day(0)), (3, day(1)), (3, day(9))])
    found = go(spark, folder, out, progress)
    assert {r["user_id"]: r["late"] for r in S.late_events(found).collect()} == {1: 2, 3: 1}
    assert tuples(found.where("kind = 'session'")) == [(1, day(0), day(0), 1)]
    assert tuples(S.open_sessions(spark, progress)) == [(2, day(10), day(10), 1), (3, day(9), day(9), 1)]


def test_minutes_before_the_shuffle(spark):
    """100 000 events of one user in one hour send at most one row for each minute and Arrow batch."""
    folder = new_path(spark, "hot")
    many = spark.range(0, 100_000, 1, 2).selectExpr(
        "id AS event_id", "timestampadd(microsecond, id * 36000, timestamp_ntz'2024-01-01') AS ts", "cast(7 as bigint) AS user_id",
        "'view' AS event_type", "1.0D AS value", "'{}' AS props",
    )
    many.write.parquet(folder)
    pieces = S.minutes_of(spark.read.parquet(folder), "user_id", "ts", "2 days").where("who is not null")
    assert pieces.count() < 200
    assert pieces.agg({"events": "sum"}).first()[0] == 100_000


def test_short_gap_is_an_error(spark):
    with pytest.raises(ValueError):
        S.timed_sessions(events(spark, []), gap_minutes=0.5)
