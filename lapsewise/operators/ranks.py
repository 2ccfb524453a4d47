"""Running totals, ranks and exact quantiles without an unbounded single-partition window.

Rows are first collapsed to one row per (group, distinct value) with counts, so ties of any size
become one row. The collapsed table is range-partitioned by (group, value) and written together
with the number of the range each row fell into; the number of ranges is the session's number of
shuffle partitions. Because a row's range is stored, recomputing a lost task cannot change it. A
running total is then: total of all earlier ranges (one row per range and group) plus a window
inside the range. There is one plan for every size.

``by`` columns are for few groups (features, labels, segments, strata), not for one group per
player.
"""

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lapsewise.operators.joins import join_lookup
from lapsewise.sources.workspace import materialise


def into_ranges(table: DataFrame, value: str, by: list[str] = (), ranges: int | None = None) -> DataFrame:
    """Write the table range-partitioned, with the range in ``_range``.

    (by, value) has to be unique, so that no value spans two ranges.
    """
    if ranges is None:
        ranges = int(table.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # range bounds are sampled, which would run the table's plan twice
    written = materialise(table, "collapsed")
    placed = written.repartitionByRange(ranges, *by, value).withColumn("_range", F.spark_partition_id())
    return materialise(placed, "ranges")


def collapse(
    df: DataFrame,
    value: str,
    by: list[str] = (),
    sums: dict | None = None,
    ranges: int | None = None,
) -> DataFrame:
    """One row per (by, value), placed in ranges: row count ``n`` and the requested sums."""
    aggregates = [F.count(F.lit(1)).alias("n")]
    aggregates += [F.sum(expr).alias(name) for name, expr in (sums or {}).items()]
    return into_ranges(df.groupBy(*by, value).agg(*aggregates), value, list(by), ranges)


def running_totals(
    placed: DataFrame,
    value: str,
    measures: list[str] = ("n",),
    by: list[str] = (),
    descending: bool = False,
) -> DataFrame:
    """Add ``cum_<m>`` (inclusive, in value order) and ``total_<m>`` for each measure."""
    direction = F.desc if descending else F.asc
    group = W.partitionBy(*by) if by else W.partitionBy(F.lit(0))
    totals = placed.groupBy(*by, "_range").agg(*[F.sum(m).alias(f"_sum_{m}") for m in measures])
    earlier = group.orderBy(direction("_range")).rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select(
        *by,
        "_range",
        *[F.coalesce(F.sum(f"_sum_{m}").over(earlier), F.lit(0)).alias(f"_before_{m}") for m in measures],
        *[F.sum(f"_sum_{m}").over(group).alias(f"total_{m}") for m in measures],
    )
    inside = (
        W.partitionBy(*by, "_range")
        .orderBy(direction(value))
        .rowsBetween(W.unboundedPreceding, W.currentRow)
    )
    joined = placed.join(offsets, [*by, "_range"])
    summed = joined.select(
        "*", *[(F.col(f"_before_{m}") + F.sum(m).over(inside)).alias(f"cum_{m}") for m in measures]
    )
    return summed.drop("_range", *[f"_before_{m}" for m in measures])


def unpivot_numeric(df: DataFrame, columns: list[str], keep: list[str] = ()) -> DataFrame:
    """Long form (keep..., feature, value) of numeric columns, nulls left out."""
    typed = df.select(*keep, *[F.col(c).cast("double").alias(c) for c in columns])
    return typed.unpivot(list(keep), columns, "feature", "value").where(F.col("value").isNotNull())


def quantiles(df: DataFrame, columns: list[str], fractions: list[float], by: list[str] = ()) -> DataFrame:
    """Exact linear-interpolation quantiles: (by..., feature, fraction, quantile).

    One pass over the data serves all columns, groups and fractions, for any number of groups. For few groups
    ``brackets`` finds the same without moving the values.
    """
    keys = [*by, "feature"]
    placed = collapse(unpivot_numeric(df, columns, by), "value", keys)
    ranked = running_totals(placed, "value", ["n"], keys)
    first = F.col("cum_n") - F.col("n")  # 0-based position of the first row with this value

    def position(q):
        return (F.col("total_n") - 1).cast("double") * q

    def holds(index):
        return (index >= first) & (index < F.col("cum_n"))

    wanted = F.filter(
        F.array(*[F.lit(float(q)) for q in fractions]),
        lambda q: holds(F.floor(position(q))) | holds(F.ceil(position(q))),
    )
    hits = ranked.select(*keys, "value", "cum_n", "n", "total_n", F.explode(wanted).alias("fraction"))
    at = position(F.col("fraction"))
    low = F.max(F.when(holds(F.floor(at)), F.col("value")))
    high = F.max(F.when(holds(F.ceil(at)), F.col("value")))
    part = F.max(at - F.floor(at))
    return hits.groupBy(*keys, "fraction").agg((low + part * (high - low)).alias("quantile"))


def rank_table(placed: DataFrame) -> DataFrame:
    """(feature, value, n, pct): average-tie percentile rank of each value of a collapsed table."""
    ranked = running_totals(placed, "value", ["n"], ["feature"])
    average = (F.col("cum_n") - F.col("n")) + (F.col("n") + 1) / F.lit(2.0)
    pct = average.cast("double") / F.col("total_n").cast("double")
    return ranked.select("feature", "value", "n", pct.alias("pct"))


def with_rank_pct(df: DataFrame, columns: dict[str, str], key: str, **join_options) -> DataFrame:
    """Add the percentile rank of each column: {source column: new column}; null stays null.

    ``df`` should be a stored table: it is read for the ranks and again for the rows.
    """
    # ranks are used once per column, so they are written; the table has one row per distinct value
    placed = collapse(unpivot_numeric(df, list(columns)), "value", ["feature"])
    ranked = materialise(rank_table(placed), "ranks")
    out = df
    for source, name in columns.items():
        lookup = ranked.where(F.col("feature") == source).select(
            F.col("value").alias("_value"), "n", F.col("pct").alias(name)
        )
        out = out.withColumn("_value", F.col(source).cast("double"))
        out = join_lookup(out, lookup, ["_value"], "n", [key], **join_options).drop("_value")
    return out


def ecdf(df: DataFrame, column: str) -> DataFrame:
    """(value, cdf): share of rows at or below each distinct value, null counted as 0."""
    values = df.select(F.coalesce(F.col(column).cast("double"), F.lit(0.0)).alias("value"))
    ranked = running_totals(collapse(values, "value"), "value")
    return ranked.select("value", (F.col("cum_n") / F.col("total_n")).alias("cdf"))


def pareto(df: DataFrame, column: str) -> DataFrame:
    """Cumulative revenue share against cumulative player share, highest spend first.

    One row per distinct amount, at its last player. Within a tie every player adds the same
    amount, so the curve between two rows is a straight line and nothing is lost.
    """
    values = df.select(F.coalesce(F.col(column).cast("double"), F.lit(0.0)).alias("value"))
    placed = collapse(values, "value", sums={"amount": F.col("value")})
    ranked = running_totals(placed, "value", ["n", "amount"], descending=True)
    return ranked.select(
        "value",
        F.col("n"),
        F.col("cum_n"),
        (F.col("cum_n") / F.col("total_n") * 100.0).alias("pct_players"),
        F.try_divide(F.col("cum_amount"), F.col("total_amount")).alias("cum_share"),
    )


def top_share(df: DataFrame, column: str, share: float = 0.20) -> DataFrame:
    """Revenue share of the top ``share`` of players (floor of the count), exact under ties."""
    values = df.select(F.coalesce(F.col(column).cast("double"), F.lit(0.0)).alias("value"))
    placed = collapse(values, "value", sums={"amount": F.col("value")})
    ranked = running_totals(placed, "value", ["n", "amount"], descending=True)
    limit = F.floor(F.col("total_n") * F.lit(share))
    taken = F.greatest(F.least(F.col("n"), limit - (F.col("cum_n") - F.col("n"))), F.lit(0))
    return ranked.agg(
        F.max(limit).alias("top_players"),
        F.try_divide(F.sum(taken * F.col("value")), F.max("total_amount")).alias("revenue_share"),
    )


def top_n(df: DataFrame, order: list, n: int) -> DataFrame:
    """First n rows by a total order; Spark keeps n rows per task, no full sort."""
    return df.orderBy(*order).limit(n)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNotNull()).select(column).distinct().orderBy(column)


def nth_smallest(table: DataFrame, column: str, n: int, digits: int = 3, few: int = 4096) -> str | None:
    """The n-th smallest of a column's unique hexadecimal texts of one length; None if there are fewer.

    Rows are counted by the next ``digits`` digits and the search goes on inside the range that holds the
    n-th, until it has ``few`` rows. The driver gets 16 ** digits counts a step, and those few texts.
    """
    prefix, before = "", 0
    while True:
        inside = table.where(F.col(column).startswith(prefix))
        counts = inside.groupBy(F.substring(column, 1, len(prefix) + digits).alias("range")).count()
        for row in sorted(counts.collect()):
            if before + row["count"] >= n:
                break
            before += row["count"]
        else:
            return None
        prefix = row["range"]
        if row["count"] <= few:
            rest = table.where(F.col(column).startswith(prefix)).select(column).collect()
            return sorted(r[column] for r in rest)[n - before - 1]


def seeded_sample(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """Exactly min(n, rows) rows, the same ones on every run: the n smallest key hashes.

    The rows are stored with their hash, and those up to the n-th are kept by a filter, so no task gathers
    the sample. Rows with one key are told apart by their stored place; a null key counts as empty.
    """
    if n <= 0:
        return df.limit(0)
    text = F.coalesce(F.col(key).cast("string"), F.lit(""))
    place = F.lpad(F.hex(F.monotonically_increasing_id()), 16, "0")
    drawn = materialise(df.withColumn("_draw", F.concat(F.md5(F.concat(text, F.lit(f"#{seed}"))), F.lower(place))), "draws")
    last = nth_smallest(drawn, "_draw", n)
    return (drawn if last is None else drawn.where(F.col("_draw") <= last)).drop("_draw")
