"""From orders, line items and customers to one row per player.

Each side is aggregated on its own before the joins, so nothing fans out. The per-customer order
summary is written once and read three times (as-of date, streak, final join).
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapsewise import constants as K
from lapsewise.functions.labels import churn_label
from lapsewise.functions.numeric import round_even
from lapsewise.operators.joins import join_lookup
from lapsewise.schema import PLAYER_SCHEMA
from lapsewise.sources.workspace import materialise

# Market segment to game mode, and the remainder of custkey % 50 whose players
# have the column masked.
MODE_OF_SEGMENT = {
    "BUILDING": "PvP",
    "AUTOMOBILE": "PvP",
    "MACHINERY": "PvE",
    "FURNITURE": "Co-op",
    "HOUSEHOLD": "Solo",
}
NULL_MASKS = {
    "avg_session_duration": 7,
    "win_rate": 17,
    "total_spend_usd": 27,
    "friend_count": 37,
}
#: Rows of one task that joins or adds up items, and the tasks that share one customer's items.
ITEM_ROWS, SPREAD = 250_000, 16
#: Rows of one task that adds up orders.
ORDER_ROWS = 500_000
#: Orders followed by the sketch that looks for those of very many items.
TRACKED = 65_536
ITEM_COLUMNS = {
    "avg_session_duration",
    "total_playtime_hours",
    "win_rate",
    "friend_count",
    "achievement_count",
}


def last_break(order_by: list[str], loss: Column) -> Column:
    """Aggregate: position of the latest play that was not a loss, null if all were losses."""
    return F.max(F.when(~F.coalesce(loss, F.lit(False)), F.struct(*order_by)))


def streak_after(
    plays: DataFrame, key: str, order_by: list[str], loss: Column, breaks: DataFrame, **join_options
) -> DataFrame:
    """(key, streak): losses after the last break.

    ``breaks`` has one row per key: key, n (plays of the key) and last_break. Counting rows past a
    known position needs no sort and no window per key, so a key with a third of all plays is
    spread over tasks by ``join_lookup``.
    """
    losses = plays.where(F.coalesce(loss, F.lit(False))).select(key, *order_by)
    placed = join_lookup(losses, breaks, [key], "n", order_by, how="inner", **join_options)
    trailing = F.col("last_break").isNull() | (F.struct(*order_by) > F.col("last_break"))
    return placed.groupBy(key).agg(F.count(F.when(trailing, F.lit(1))).alias("streak"))


def loss_streak(plays: DataFrame, key: str, order_by: list[str], loss: Column, **join_options) -> DataFrame:
    """Length of the trailing run of losses per key; keys without one get 0."""
    breaks = materialise(
        plays.groupBy(key).agg(F.count(F.lit(1)).alias("n"), last_break(order_by, loss).alias("last_break")),
        "breaks",
    )
    streaks = streak_after(plays, key, order_by, loss, breaks, **join_options)
    return breaks.select(key).join(streaks, key, "left").select(
        key, F.coalesce("streak", F.lit(0)).alias("streak")
    )


def recency(last_seen: Column, as_of: Column) -> Column:
    return F.datediff(as_of, last_seen).cast("bigint")


def inject_nulls(df: DataFrame, masks: dict[str, int], key: str, modulus: int = 50) -> DataFrame:
    """Set a column to null where key % modulus equals its remainder (1 in ``modulus`` rows)."""
    return df.select([
        F.when(F.pmod(F.col(key), F.lit(modulus)) != masks[c], F.col(c)).alias(c) if c in masks else F.col(c)
        for c in df.columns
    ])


def order_activity(orders: DataFrame) -> DataFrame:
    """One row per customer: sessions, first and last day, spend, latest play that was not lost.

    The greatest struct of a customer is found by sorting, so a task that reads a whole split of a file would hold
    it in memory: the orders are dealt to tasks of about ORDER_ROWS first, which also share a customer of very many.
    """
    cents = F.rint(F.col("o_totalprice") * 100.0).cast("bigint")
    urgent = F.col("o_orderpriority") == "1-URGENT"
    rows = orders.select(
        "o_custkey", "o_orderkey", "o_orderdate", F.when(urgent, cents).otherwise(F.lit(0)).alias("cents"),
        (F.col("o_orderstatus") == "F").alias("lost"),
    )
    parts = max(1, -(-orders.count() // ORDER_ROWS))
    return rows.repartition(parts, "o_orderkey", "o_orderdate", "cents").groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("session_count"),
        F.min("o_orderdate").alias("first_seen"),
        F.max("o_orderdate").alias("last_seen"),
        F.sum("cents").alias("spend_cents"),
        last_break(["o_orderdate", "o_orderkey"], F.col("lost")).alias("last_break"),
    )


def large_orders(lineitem: DataFrame) -> DataFrame:
    """(l_orderkey, pieces) of orders with more than ITEM_ROWS items, or one in 10 000 of all items if that is more.

    A sketch of bounded size names every such order, and the named ones are counted exactly.
    """
    keys = lineitem.select("l_orderkey").where("l_orderkey IS NOT NULL")
    top = keys.agg(F.expr(f"approx_top_k(l_orderkey, {TRACKED}, {TRACKED})").alias("top"))
    named = materialise(top.select(F.explode("top.item").alias("l_orderkey")), "named_orders")
    counted = keys.join(F.broadcast(named), "l_orderkey").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))
    pieces = F.ceil(F.col("n") / ITEM_ROWS).cast("bigint").alias("pieces")
    return materialise(counted.where(F.col("n") > ITEM_ROWS).select("l_orderkey", pieces), "large_orders")


def with_owner(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """The items with the customers of their orders, joined in tasks of about ITEM_ROWS items; a large order is cut in pieces."""
    parts = max(1, -(-lineitem.count() // ITEM_ROWS))
    large = F.broadcast(large_orders(lineitem))
    place = F.xxhash64("l_partkey", "l_suppkey", "l_quantity", "l_returnflag")
    items = lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag").join(large, "l_orderkey", "left")
    items = items.withColumn("piece", F.coalesce(F.pmod(place, F.col("pieces")), F.lit(0))).drop("pieces")
    owner = orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey").join(large, "l_orderkey", "left")
    owner = owner.withColumn("piece", F.explode(F.sequence(F.lit(0), F.coalesce("pieces", F.lit(1)) - 1))).drop("pieces")
    on = ["l_orderkey", "piece"]
    return items.repartition(parts, *on).join(owner.repartition(parts, *on).hint("merge"), on).drop("piece")


def item_activity(lineitem: DataFrame, orders: DataFrame, owner_parts: int | None = None) -> DataFrame:
    """One row per customer: quantity, win rate, distinct parts and suppliers.

    Both sides grow with the data, so the join shuffles and never broadcasts the orders. Its tasks are bounded by
    rows, not by the bytes that Spark would merge. Hardly any two items of a customer share a part or
    supplier, so adding them up before the shuffle would only fill memory: the items are dealt by
    (customer, part or supplier) to tasks of about ITEM_ROWS rows and added up there. The parts and
    suppliers of a customer go to SPREAD tasks at most, which bounds the rows sent on for each customer. With
    ``owner_parts`` the customers are dealt to so many tasks; without, Spark merges their tasks by bytes.
    """
    won = (F.col("l_returnflag") != "R").cast("int")
    nothing = F.lit(None)

    def cell(*values: Column) -> Column:
        return F.struct(*[v.alias(name) for v, name in zip(values, ("part", "item", "quantity", "won"))])

    cells = F.array(
        cell(F.lit(True), F.col("l_partkey"), F.col("l_quantity"), won),
        cell(F.lit(False), F.col("l_suppkey"), nothing.cast("double"), nothing.cast("int")),
    )
    rows = with_owner(lineitem, orders).select("o_custkey", F.inline(cells))
    parts = max(1, -(-2 * lineitem.count() // ITEM_ROWS))
    rows = rows.withColumn("spread", F.pmod(F.xxhash64("part", "item"), F.lit(SPREAD)))
    each = rows.repartition(parts, "o_custkey", "spread").groupBy("o_custkey", "spread", "part", "item").agg(
        F.sum("quantity").alias("quantity"), F.sum("won").alias("won"), F.count("won").alias("played")
    )
    some = F.col("item").isNotNull()
    pieces = each.groupBy("o_custkey", "spread").agg(
        F.sum("quantity").alias("quantity"), F.sum("won").alias("won"), F.sum("played").alias("played"),
        F.count_if(some & ~F.col("part")).alias("suppliers"), F.count_if(some & F.col("part")).alias("parts"),
    )
    sums = pieces if owner_parts is None else pieces.repartition(owner_parts, "o_custkey")
    return sums.groupBy("o_custkey").agg(
        F.sum("quantity").alias("quantity"),
        F.try_divide(F.sum("won").cast("double"), F.sum("played")).alias("won_share"),
        F.sum("suppliers").alias("suppliers"),
        F.sum("parts").alias("parts"),
    )


def player_profile(
    customer: DataFrame,
    orders: DataFrame,
    lineitem: DataFrame,
    threshold: int = K.CHURN_DAYS,
    columns: list[str] | None = None,
    masks: dict[str, int] = NULL_MASKS,
) -> DataFrame:
    """The player table (schema.PLAYER_SCHEMA plus join_date), one row per customer with orders.

    Naming the wanted columns skips the feeders that they do not need: without item columns the
    line items are not read, without consecutive_losses the orders are read once.
    """
    wanted = [*PLAYER_SCHEMA.names, "join_date"] if columns is None else list(columns)
    activity = materialise(order_activity(orders), "activity")
    as_of = activity.agg(F.max("last_seen").alias("as_of"))
    base = activity.join(
        customer.select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment"), "o_custkey"
    ).withColumn("as_of", as_of.scalar())

    if "consecutive_losses" in wanted:
        breaks = activity.select("o_custkey", F.col("session_count").alias("n"), "last_break")
        streaks = streak_after(
            orders, "o_custkey", ["o_orderdate", "o_orderkey"], F.col("o_orderstatus") == "F", breaks
        )
        base = base.join(streaks, "o_custkey", "left")
    else:
        base = base.withColumn("streak", F.lit(None).cast("bigint"))
    if ITEM_COLUMNS & set(wanted):
        parts = max(1, -(-SPREAD * activity.count() // ITEM_ROWS))
        base = base.repartition(parts, "o_custkey").join(item_activity(lineitem, orders, parts), "o_custkey", "left")
    else:
        base = base.select(
            "*",
            *[F.lit(None).cast(t).alias(c) for c, t in [
                ("quantity", "double"), ("won_share", "double"), ("suppliers", "bigint"), ("parts", "bigint")
            ]],
        )

    mode = F.create_map(*[F.lit(x) for pair in MODE_OF_SEGMENT.items() for x in pair])
    quantity = F.coalesce("quantity", F.lit(0.0))
    days = recency(F.col("last_seen"), F.col("as_of"))
    profile = base.select(
        "o_custkey",
        F.format_string("P%06d", "o_custkey").alias("player_id"),
        F.col("session_count"),
        round_even(quantity / F.col("session_count"), 1).alias("avg_session_duration"),
        days.alias("last_login_days_ago"),
        round_even(quantity / 60.0, 2).alias("total_playtime_hours"),
        round_even(F.col("won_share"), 3).alias("win_rate"),
        round_even(F.col("spend_cents") / 1_000_000.0, 2).alias("total_spend_usd"),
        F.floor(F.coalesce("suppliers", F.lit(0)) / 4.0).cast("bigint").alias("friend_count"),
        mode[F.col("c_mktsegment")].alias(K.MODE),
        F.coalesce("parts", F.lit(0)).cast("bigint").alias("achievement_count"),
        F.coalesce("streak", F.lit(0)).cast("bigint").alias("consecutive_losses"),
        churn_label(days, threshold).alias(K.LABEL),
        F.to_date("first_seen").alias("join_date"),
    )
    return inject_nulls(profile, masks, "o_custkey").select(*wanted)
