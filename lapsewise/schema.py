"""Declared schemas; nothing in this package infers one from data."""

from pyspark.sql import types as T

PLAYER_SCHEMA = T.StructType([
    T.StructField("player_id", T.StringType(), False),
    T.StructField("session_count", T.LongType()),
    T.StructField("avg_session_duration", T.DoubleType()),
    T.StructField("last_login_days_ago", T.LongType()),
    T.StructField("total_playtime_hours", T.DoubleType()),
    T.StructField("win_rate", T.DoubleType()),
    T.StructField("total_spend_usd", T.DoubleType()),
    T.StructField("friend_count", T.LongType()),
    T.StructField("game_mode_primary", T.StringType()),
    T.StructField("achievement_count", T.LongType()),
    T.StructField("consecutive_losses", T.LongType()),
    T.StructField("churn_label", T.IntegerType()),
])

EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])

# Columns of the star-schema tables that this package reads.
TABLE_SCHEMAS = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
        "l_shipdate timestamp_ntz"
    ),
    "events": EVENT_SCHEMA,
    "embeddings": "vec_id bigint, embedding array<float>, label int",
}
