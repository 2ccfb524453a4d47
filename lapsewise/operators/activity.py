"""Event-table operators: sessions and trailing activity."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


#: Cells of one gap that a piece of a user's time holds.
CELLS = 1024


def cells(pieces: DataFrame, user: str, gap: int) -> DataFrame:
    """(user, first, last, events): pieces of sessions that begin in one cell of a gap's length, added up.

    Their beginnings are less than a gap apart, so they belong to one session. The aggregate combines before
    the shuffle: a task sends one row for each cell, however many events a user has in it.
    """
    cell = F.expr(f"div(first, {max(gap, 1)}) - int(first < 0 AND first % {max(gap, 1)} <> 0)")
    return pieces.groupBy(user, cell.alias("cell")).agg(
        F.min("first").alias("first"), F.max("last").alias("last"), F.sum("events").alias("events")
    ).drop("cell")


def sessionize(events: DataFrame, user: str, ts: str, gap_minutes: float = 30.0, chunk_minutes: float | None = None) -> DataFrame:
    """(user, session_start, session_end, events): a new session starts after a longer gap.

    Events are added up to cells first, and the cells are cut into (user, time chunk) pieces, by default
    of 1 024 gaps, so a window holds at most 1 025 rows of a user at any number of events. Inside a piece
    the gaps give segments. Only the first and the last segment of a piece can touch a neighbouring piece;
    these, at most two per user and chunk, are stitched in a second step, the segments in between are
    sessions already.
    """
    gap = int(gap_minutes * 60_000_000)
    size = int(chunk_minutes * 60_000_000) if chunk_minutes else max(gap, 1) * CELLS
    times = events.where(F.col(ts).isNotNull() & F.col(user).isNotNull()).select(user, micros(F.col(ts)).alias("first"))
    rows = cells(times.withColumn("last", F.col("first")).withColumn("events", F.lit(1)), user, gap)
    rows = rows.withColumn("chunk", F.floor(F.col("first") / F.lit(float(size))))
    piece = W.partitionBy(user, "chunk").orderBy("first")
    flagged = rows.withColumn(
        "new", F.coalesce((F.col("first") - F.lag("last").over(piece) > gap).cast("int"), F.lit(0))
    )
    numbered = flagged.withColumn("segment", F.sum("new").over(piece.rowsBetween(W.unboundedPreceding, 0)))
    segments = numbered.groupBy(user, "chunk", "segment").agg(
        F.min("first").alias("first"), F.max("last").alias("last"), F.sum("events").alias("events")
    )
    last_segment = F.max("segment").over(W.partitionBy(user, "chunk"))
    marked = segments.withColumn("edge", (F.col("segment") == 0) | (F.col("segment") == last_segment))
    inner = marked.where(~F.col("edge")).select(user, "first", "last", "events")

    line = W.partitionBy(user).orderBy("first")
    edges = marked.where("edge").withColumn(
        "new", F.coalesce((F.col("first") - F.lag("last").over(line) > gap).cast("int"), F.lit(1))
    ).withColumn("session", F.sum("new").over(line.rowsBetween(W.unboundedPreceding, 0)))
    stitched = edges.groupBy(user, "session").agg(
        F.min("first").alias("first"), F.max("last").alias("last"), F.sum("events").alias("events")
    )
    return stitched.select(user, "first", "last", "events").unionByName(inner).select(
        user,
        F.timestamp_micros("first").alias("session_start"),
        F.timestamp_micros("last").alias("session_end"),
        "events",
    )


def stitched(pieces: DataFrame, user: str, gap_minutes: float) -> DataFrame:
    """Sessions from pieces of sessions that may overlap: (user, session_start, session_end, events).

    The window over a user's time holds one row for each cell of a gap's length at most.
    """
    gap = int(gap_minutes * 60_000_000)
    rows = pieces.select(user, micros(F.col("session_start")).alias("first"), micros(F.col("session_end")).alias("last"), "events")
    rows = cells(rows, user, gap)
    line = W.partitionBy(user).orderBy("first")
    before = F.max("last").over(line.rowsBetween(W.unboundedPreceding, -1))
    rows = rows.withColumn("new", F.coalesce((F.col("first") - before > gap).cast("int"), F.lit(1)))
    rows = rows.withColumn("session", F.sum("new").over(line.rowsBetween(W.unboundedPreceding, 0)))
    return rows.groupBy(user, "session").agg(
        F.timestamp_micros(F.min("first")).alias("session_start"), F.timestamp_micros(F.max("last")).alias("session_end"), F.sum("events").alias("events")
    ).drop("session")


def session_summary(sessions: DataFrame, user: str) -> DataFrame:
    """(user, session_count, avg_session_duration in minutes)."""
    minutes = (micros(F.col("session_end")) - micros(F.col("session_start"))) / F.lit(60_000_000.0)
    return sessions.groupBy(user).agg(
        F.count(F.lit(1)).alias("session_count"), F.avg(minutes).alias("avg_session_duration")
    )


def rolling_activity(events: DataFrame, user: str, ts: str, days: int = 7) -> DataFrame:
    """(user, day, events, trailing): events of the day and of the last ``days`` days.

    Counts per day come first, so a window partition holds one row per calendar day of a user.
    """
    daily = events.where(F.col(ts).isNotNull()).groupBy(user, F.to_date(ts).alias("day")).agg(
        F.count(F.lit(1)).alias("events")
    )
    window = W.partitionBy(user).orderBy(F.unix_date("day")).rangeBetween(-(days - 1), 0)
    return daily.withColumn("trailing", F.sum("events").over(window))
