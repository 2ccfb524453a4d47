"""Event sessions and windows, batch and streaming."""

from pyspark.sql import functions as F

from lapsewise.operators import activity as B
from lapsewise.queries.base import query, r, rounded
from lapsewise.sources.tables import read_table
from lapsewise.sources.workspace import new_path
from lapsewise.streaming import activity as T
from lapsewise.streaming import sessions as S

GAP_MINUTES = 360

_SESSIONS = f"""WITH o AS (SELECT user_id, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS prev FROM events),
  n AS (SELECT user_id, ts, sum(CASE WHEN prev IS NULL OR epoch_us(ts) - epoch_us(prev) > {GAP_MINUTES * 60_000_000} THEN 1 ELSE 0 END)
        OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS session FROM o),
  s AS (SELECT user_id, session, min(epoch_us(ts)) AS first, max(epoch_us(ts)) AS last, count(*) AS events FROM n GROUP BY 1, 2)"""


def _in_micros(df):
    return df.select(
        "user_id", F.unix_micros(F.col("session_start").cast("timestamp")).alias("first"),
        F.unix_micros(F.col("session_end").cast("timestamp")).alias("last"), "events",
    )


@query("sessionize", f"{_SESSIONS} SELECT user_id, first, last, events FROM s")
def sessionize(spark, sf_dir):
    return _in_micros(B.sessionize(read_table(spark, sf_dir, "events"), "user_id", "ts", GAP_MINUTES))


@query(
    "session_summary",
    f"{_SESSIONS} SELECT user_id, count(*) AS session_count, {r('avg((last - first) / 6e7)', 6)} AS avg_session_duration FROM s GROUP BY 1",
)
def session_summary(spark, sf_dir):
    sessions = B.sessionize(read_table(spark, sf_dir, "events"), "user_id", "ts", GAP_MINUTES)
    return rounded(B.session_summary(sessions, "user_id"), 6, "avg_session_duration")


_DAILY = "d AS (SELECT user_id, CAST(ts AS DATE) AS day, count(*) AS events FROM events GROUP BY 1, 2)"


@query(
    "rolling_activity_7d",
    f"""WITH {_DAILY} SELECT user_id, strftime(day, '%Y-%m-%d') AS day, events, CAST(sum(events) OVER (
        PARTITION BY user_id ORDER BY day RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW) AS BIGINT) AS trailing FROM d""",
)
def rolling_activity_7d(spark, sf_dir):
    out = B.rolling_activity(read_table(spark, sf_dir, "events"), "user_id", "ts")
    return out.withColumn("day", F.date_format("day", "yyyy-MM-dd"))


def _partial(spark, sf_dir):
    out = new_path(spark, "activity")
    events = T.read_events(spark, f"{sf_dir}/events.parquet*")
    T.start_partial_sink(events, out, new_path(spark, "activity-progress"), gap_minutes=GAP_MINUTES).awaitTermination()
    return out


@query("stream_daily_counts", f"WITH {_DAILY} SELECT user_id, strftime(day, '%Y-%m-%d') AS day, events FROM d")
def stream_daily_counts(spark, sf_dir):
    return T.merged_days(spark, _partial(spark, sf_dir)).withColumn("day", F.date_format("day", "yyyy-MM-dd"))


@query(
    "stream_weekly_counts",
    f"""WITH {_DAILY}, x AS (SELECT user_id, day + CAST(k AS INTEGER) AS last_day, events FROM d, range(7) t(k))
        SELECT user_id, strftime(last_day, '%Y-%m-%d') AS last_day, CAST(sum(events) AS BIGINT) AS trailing FROM x GROUP BY user_id, last_day""",
)
def stream_weekly_counts(spark, sf_dir):
    return T.merged_weeks(spark, _partial(spark, sf_dir)).withColumn("last_day", F.date_format("last_day", "yyyy-MM-dd"))


@query("stream_session_counts", f"{_SESSIONS} SELECT user_id, first, last, events FROM s")
def stream_session_counts(spark, sf_dir):
    return _in_micros(T.merged_sessions(spark, _partial(spark, sf_dir), gap_minutes=GAP_MINUTES))


@query("stream_timed_sessions", f"{_SESSIONS} SELECT user_id, first, last, events FROM s")
def stream_timed_sessions(spark, sf_dir):
    """Sessions closed by their timers, and those still open in the state when the input has ended."""
    out, progress = new_path(spark, "timed"), new_path(spark, "timed-progress")
    stream = S.timed_sessions(T.read_events(spark, f"{sf_dir}/events.parquet*"), gap_minutes=GAP_MINUTES)
    S.start_timed_sessions(stream, out, progress).awaitTermination()
    closed = S.recorded(spark, out, stream.schema).where("kind = 'session'").drop("kind")
    return _in_micros(closed.unionByName(S.open_sessions(spark, progress)))
