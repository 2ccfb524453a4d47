"""Readers for the star-schema tables and for player tables at rest."""

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapsewise.functions.numeric import nan_to_null
from lapsewise.schema import PLAYER_SCHEMA, TABLE_SCHEMAS

log = logging.getLogger(__name__)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLE_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def load_players(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """Player table with the declared schema; NaN in numeric columns becomes null."""
    reader = spark.read.schema(PLAYER_SCHEMA)
    if fmt == "csv":
        # enforceSchema=False checks the header, so columns in another order are an error
        reader = reader.option("header", True).option("nanValue", "NaN").option("enforceSchema", False)
    df = reader.format(fmt).load(path)
    return df.select([
        nan_to_null(F.col(f.name)).alias(f.name) if f.dataType.typeName() == "double" else F.col(f.name)
        for f in df.schema.fields
    ])


def load_json_records(spark: SparkSession, path: str) -> DataFrame:
    """One untyped JSON text per record, in a column ``record``.

    The text stays untyped so that validation can tell missing, null and wrongly typed fields
    apart; see ``operators.scoring.validate``.
    """
    return spark.read.text(path).select(F.col("value").alias("record")).where("trim(record) <> ''")


def load_splits(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    """The matrix table; asking for one split reads only that partition."""
    df = spark.read.parquet(path)
    return df if split is None else df.where(F.col("split") == split)


def available(df: DataFrame, wanted: list[str]) -> list[str]:
    """The wanted columns that the table has, in wanted order; absent ones are logged."""
    missing = [c for c in wanted if c not in df.columns]
    if missing:
        log.warning("columns not found, left out: %s", missing)
    return [c for c in wanted if c in df.columns]

