"""Event-time activity: windows with watermarks, and complete results by merging on read.

A stream in append mode gives a window once the watermark has passed its end, and drops later
events. ``start_partial_sink`` keeps no state instead: each micro-batch writes its own day counts
and session pieces, under its batch number, so a repeated batch replaces itself. Readers add the
counts and stitch the pieces, and at any time see all events read so far, late ones among them.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from lapsewise.operators.activity import sessionize, stitched
from lapsewise.schema import EVENT_SCHEMA


def read_events(spark: SparkSession, path: str, per_trigger: int | None = None) -> DataFrame:
    """Stream of event files. ``path`` may be a folder or a glob."""
    reader = spark.readStream.schema(EVENT_SCHEMA)
    if per_trigger:
        reader = reader.option("maxFilesPerTrigger", per_trigger)
    return with_event_time(reader.parquet(path))


def with_event_time(events: DataFrame, ts: str = "ts") -> DataFrame:
    """A watermark needs a timestamp with time zone; NTZ values are taken as session time."""
    if isinstance(events.schema[ts].dataType, T.TimestampNTZType):
        return events.withColumn(ts, F.col(ts).cast("timestamp"))
    return events


def daily_counts(events: DataFrame, user: str = "user_id", ts: str = "ts", late: str = "2 days") -> DataFrame:
    """(user, day_start, events) per tumbling day."""
    return events.withWatermark(ts, late).groupBy(F.window(ts, "1 day").alias("day"), user).agg(
        F.count(F.lit(1)).alias("events")
    )


def flat_daily(counts: DataFrame, user: str = "user_id") -> DataFrame:
    return counts.select(user, F.col("day.start").alias("day_start"), "events")


def weekly_counts(events: DataFrame, user: str = "user_id", ts: str = "ts", late: str = "2 days") -> DataFrame:
    """(user, last_day, trailing) per sliding 7-day window.

    Days are counted first and the sliding window runs over the day counts, so an event is not
    copied into seven windows.
    """
    days = daily_counts(events, user, ts, late)
    slid = days.groupBy(F.window(F.window_time("day"), "7 days", "1 day").alias("week"), user).agg(
        F.sum("events").alias("trailing")
    )
    return slid.select(user, F.to_date(F.date_sub(F.to_date("week.end"), 1)).alias("last_day"), "trailing")


def session_counts(
    events: DataFrame, user: str = "user_id", ts: str = "ts", gap: str = "30 minutes", late: str = "2 days"
) -> DataFrame:
    """(user, session_start, session_end, events); the end is the last event."""
    grouped = events.withWatermark(ts, late).groupBy(F.session_window(ts, gap).alias("s"), user).agg(
        F.max(ts).alias("session_end"), F.count(F.lit(1)).alias("events")
    )
    return grouped.select(user, F.col("s.start").alias("session_start"), "session_end", "events")


def start_file_sink(stream: DataFrame, path: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Append to Parquet with exactly-once files; ``once`` stops when the available input is done."""
    writer = stream.writeStream.outputMode("append").format("parquet")
    writer = writer.option("path", path).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def late_rows(query: StreamingQuery) -> int:
    """Rows that arrived behind the watermark and were dropped, over the recorded batches."""
    return sum(
        int(op.get("numRowsDroppedByWatermark", 0)) for p in query.recentProgress for op in p["stateOperators"]
    )


def start_partial_sink(
    events: DataFrame, path: str, checkpoint: str, user: str = "user_id", ts: str = "ts", gap_minutes: float = 30.0, once: bool = True
) -> StreamingQuery:
    """Write each micro-batch's day counts and session pieces; a hot user's events are cut by time in both."""

    def write(batch: DataFrame, number: int) -> None:
        rows = batch.select(user, ts).persist()
        days = rows.where(F.col(ts).isNotNull()).groupBy(user, F.to_date(ts).alias("day")).agg(F.count(F.lit(1)).alias("events"))
        days.write.mode("overwrite").parquet(f"{path}/days/batch={number}")
        sessionize(rows, user, ts, gap_minutes).write.mode("overwrite").parquet(f"{path}/sessions/batch={number}")
        rows.unpersist()

    writer = events.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def merged_days(spark: SparkSession, path: str, user: str = "user_id") -> DataFrame:
    """(user, day, events) of all batches."""
    return spark.read.parquet(f"{path}/days").groupBy(user, "day").agg(F.sum("events").alias("events"))


def merged_weeks(spark: SparkSession, path: str, user: str = "user_id") -> DataFrame:
    """(user, last_day, trailing): events of the seven days that end on last_day, also on days without events."""
    days = merged_days(spark, path, user)
    return days.select(user, F.explode(F.sequence("day", F.date_add("day", 6))).alias("last_day"), "events").groupBy(user, "last_day").agg(
        F.sum("events").alias("trailing")
    )


def merged_sessions(spark: SparkSession, path: str, user: str = "user_id", gap_minutes: float = 30.0) -> DataFrame:
    """(user, session_start, session_end, events) of all batches."""
    return stitched(spark.read.parquet(f"{path}/sessions").drop("batch"), user, gap_minutes)
