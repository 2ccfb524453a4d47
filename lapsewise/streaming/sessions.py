"""Sessions as state with event-time timers, and a side output for late events.

State per user: the sessions that are still open. A timer closes a session once the watermark has passed its
end by the gap, and it leaves the state; what stays is bounded by the sessions inside the watermark's delay.
Every task first adds events of one user and minute together, so a user with very many events sends few rows
to the state. Lateness is decided by that minute: an event is late if its minute ended at or before the
watermark. Late events open or change no session; they come out as rows of kind ``late``, with their number,
so closed, open and late rows together account for every event that has a user and a time.
"""

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from lapsewise.streaming.activity import with_event_time

# executors unpickle the helpers below without having this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

MINUTE = 60_000_000
STATE = "firsts array<long>, lasts array<long>, counts array<long>"


def minutes_of(events: DataFrame, user: str, ts: str, delay: str) -> DataFrame:
    """(user, first, last, events, clock): events of each Arrow batch by user and minute, in microseconds.

    Spark drops rows behind the watermark before the state sees them, and takes the watermark from the same
    column. So the pieces have no clock, and each batch adds one row without user that has only the clock.
    """
    kind = events.schema[user].dataType.simpleString()

    def add_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                minute = (batch["t"] // MINUTE).rename("minute")
                pieces = batch["t"].groupby([batch["who"], minute]).agg(first="min", last="max", events="size").reset_index()
                pieces = pieces.drop(columns="minute").assign(clock=None)
                tick = pd.DataFrame({"who": [None], "first": [0], "last": [0], "events": [0], "clock": [int(batch["t"].max())]})
                for part in (pieces, tick):
                    yield part.astype({"clock": "Int64"})

    rows = with_event_time(events, ts).where(F.col(user).isNotNull() & F.col(ts).isNotNull())
    rows = rows.select(F.col(user).alias("who"), F.unix_micros(ts).alias("t"))
    pieces = rows.mapInPandas(add_up, f"who {kind}, first long, last long, events long, clock long")
    return pieces.withColumn("clock", F.timestamp_micros("clock")).withWatermark("clock", delay)


def merged(pieces: list[tuple[int, int, int]], gap: int) -> list[list[int]]:
    """[first, last, events] of sessions from pieces that may touch or overlap."""
    out: list[list[int]] = []
    for first, last, events in sorted(map(tuple, pieces)):
        if out and first - out[-1][1] <= gap:
            out[-1][1] = max(out[-1][1], last)
            out[-1][2] += events
        else:
            out.append([first, last, events])
    return out


def timed_sessions(events: DataFrame, user: str = "user_id", ts: str = "ts", gap_minutes: float = 30.0, delay: str = "2 days") -> DataFrame:
    """Stream of (user, kind, session_start, session_end, events); kind is ``session`` or ``late``.

    A session ends at its last event; a new one starts after a gap longer than ``gap_minutes``, which has to
    be a minute at least. Events without user or time are left out.
    """
    gap = int(gap_minutes * MINUTE)
    if gap < MINUTE:
        raise ValueError("the gap has to be a minute at least")
    kind = events.schema[user].dataType.simpleString()

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if pd.isna(key[0]):
            for _ in batches:
                pass
            return

        def named(kind: str, rows: pd.DataFrame) -> pd.DataFrame:
            return rows.assign(who=key[0], kind=kind)[["who", "kind", "first", "last", "events"]]

        now = state.getCurrentWatermarkMs() * 1000
        open_ = merged(list(zip(*state.get)) if state.exists else [], gap)
        if not state.hasTimedOut:
            for batch in batches:
                late = (now > 0) & ((batch["first"] // MINUTE + 1) * MINUTE <= now)
                if late.any():
                    yield named("late", batch.loc[late, ["first", "last", "events"]])
                known = batch.loc[~late, ["first", "last", "events"]]
                open_ = merged([*open_, *zip(*(known[c].tolist() for c in known))], gap)
        # an event of a minute that has not ended yet can't reach such a session any more
        over = [s for s in open_ if now > 0 and s[1] + gap + MINUTE <= now]
        rest = [s for s in open_ if not (now > 0 and s[1] + gap + MINUTE <= now)]
        if over:
            yield named("session", pd.DataFrame(over, columns=["first", "last", "events"]))
        if rest:
            state.update(tuple(list(c) for c in zip(*rest)))
            ends = min(s[1] for s in rest) + gap + MINUTE
            state.setTimeoutTimestamp(max(-(-ends // 1000), now // 1000 + 1))
        elif state.exists:
            state.remove()

    pieces = minutes_of(events, user, ts, delay)
    found = pieces.groupBy("who").applyInPandasWithState(
        step, f"who {kind}, kind string, first long, last long, events long", STATE, "append", GroupStateTimeout.EventTimeTimeout
    )
    return found.select(
        F.col("who").alias(user), "kind", F.timestamp_micros("first").alias("session_start"),
        F.timestamp_micros("last").alias("session_end"), "events",
    )


def start_timed_sessions(stream: DataFrame, path: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Append the stream of ``timed_sessions`` to Parquet, one folder for each kind."""
    writer = stream.writeStream.outputMode("append").format("parquet").partitionBy("kind")
    writer = writer.option("path", path).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def recorded(spark: SparkSession, path: str, schema) -> DataFrame:
    """All rows that the sink has committed."""
    return spark.read.schema(schema).parquet(path)


def late_events(rows: DataFrame, user: str = "user_id") -> DataFrame:
    """(user, late): exact numbers of late events, from the recorded rows."""
    return rows.where("kind = 'late'").groupBy(user).agg(F.sum("events").alias("late"))


def open_sessions(spark: SparkSession, checkpoint: str, user: str = "user_id") -> DataFrame:
    """(user, session_start, session_end, events) of the sessions in a stopped stream's state."""
    state = spark.read.format("statestore").option("path", checkpoint).load()
    held = state.select(F.col("key.who").alias(user), F.explode(F.arrays_zip(*[f"value.groupState.{c}" for c in ("firsts", "lasts", "counts")])).alias("s"))
    return held.select(
        user, F.timestamp_micros("s.firsts").alias("session_start"), F.timestamp_micros("s.lasts").alias("session_end"), F.col("s.counts").alias("events")
    )
