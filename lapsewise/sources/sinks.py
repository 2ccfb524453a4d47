"""Writers. Data-sized outputs keep their partitions; only reports are written as one file."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapsewise import constants as K
from lapsewise.sources.tables import available

EXPORT_COLUMNS = [
    "player_id",
    "segment",
    "session_count",
    "last_login_days_ago",
    "total_spend_usd",
    "win_rate",
    "churn_label",
]


def write_players(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> str:
    writer = df.write.mode(mode)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)
    return path


def write_splits(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Scaled features and label keyed by player, one folder per split."""
    df.write.mode(mode).partitionBy("split").parquet(path)
    return path


def write_report(df: DataFrame, path: str, fmt: str = "csv", mode: str = "overwrite") -> str:
    """Result whose row count does not grow with the data (profiles, comparisons, top-k)."""
    writer = df.coalesce(1).write.mode(mode)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)
    return path


def export_view(df: DataFrame, path: str, segment: str | None = None) -> str:
    """CSV of the display columns of one segment, or of all players."""
    rows = df if segment is None else df.where(F.col("segment") == segment)
    rows.select(available(df, EXPORT_COLUMNS)).write.mode("overwrite").option("header", True).csv(path)
    return path


def write_json_records(df: DataFrame, path: str) -> str:
    """Request records as JSON lines."""
    df.select(F.to_json(F.struct(*available(df, K.REQUEST_FIELDS)))).write.mode("overwrite").text(path)
    return path
