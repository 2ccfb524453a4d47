"""Continuous validated scoring with a dead-letter sink."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lapsewise.operators.models import Bundle
from lapsewise.operators.scoring import is_valid, score_records, validate
from lapsewise.streaming.activity import start_file_sink


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Stream of JSON-lines files as untyped text in ``record``."""
    return spark.readStream.text(path).select(F.col("value").alias("record")).where("trim(record) <> ''")


def scored_stream(records: DataFrame, bundle: Bundle) -> DataFrame:
    """Predictions of the valid records."""
    return score_records(records, bundle).where(F.col("error").isNull()).drop("error")


def rejected_stream(records: DataFrame) -> DataFrame:
    """(record, errors) of the invalid records; needs no model."""
    return validate(records).where(~is_valid()).select("record", "errors")


def start_scoring(
    records: DataFrame, bundle: Bundle, scored_path: str, rejected_path: str, checkpoint: str, once: bool = True
) -> tuple[StreamingQuery, StreamingQuery]:
    """Two independent file sinks with their own checkpoints; each is exactly-once on its own."""
    return (
        start_file_sink(scored_stream(records, bundle), scored_path, f"{checkpoint}/scored", once),
        start_file_sink(rejected_stream(records), rejected_path, f"{checkpoint}/rejected", once),
    )
