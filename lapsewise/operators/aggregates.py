"""Retention reports: one grouped aggregate each, over raw, winsorised or segmented players."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lapsewise import constants as K
from lapsewise.functions.numeric import (
    clip,
    count_if,
    equal_width_bin,
    equal_width_cut,
    num,
    ratio,
    right_closed_bin,
    round_even,
)
from lapsewise.operators.brackets import collect_quantiles, quantile_rows
from lapsewise.operators.joins import with_constant_map, with_overall
from lapsewise.operators.ranks import unpivot_numeric

SPEND = "total_spend_usd"


def churn_share() -> Column:
    return F.avg(F.col(K.LABEL).cast("double"))


def churn_pct(digits: int = 1) -> Column:
    return round_even(churn_share() * 100.0, digits)


def spend_or_zero() -> Column:
    return F.coalesce(num(SPEND), F.lit(0.0))


def churn_overview(df: DataFrame) -> DataFrame:
    return df.agg(
        count_if(F.col(K.LABEL) == 0).alias("active"),
        count_if(F.col(K.LABEL) == 1).alias("churned"),
        churn_pct().alias("churn_rate_pct"),
    )


def kpi_row(df: DataFrame) -> DataFrame:
    """Headline numbers; an empty selection has churn rate 0 and null averages."""
    share = F.coalesce(ratio(F.sum(K.LABEL), F.count(F.lit(1))), F.lit(0.0))
    return df.agg(
        F.count(F.lit(1)).alias("total_players"),
        F.coalesce(F.sum(F.col(K.LABEL).cast("bigint")), F.lit(0)).alias("churned_players"),
        round_even(share * 100.0, 1).alias("churn_rate_pct"),
        round_even(F.avg(spend_or_zero()), 2).alias("avg_spend"),
        round_even(F.avg(num("session_count")), 0).alias("avg_sessions"),
    )


#: The filters of the board, in the order of the bits of ``level``.
CUBE = ("game_mode", "spend_tier", "status")
_ADDED = ("players", "labelled", "churned", "spend", "sessions", "with_sessions")


def kpi_cube(df: DataFrame) -> DataFrame:
    """Sums of the headline numbers for each combination of mode, spend tier and status, and over all of each.

    Players are added up once, for the combinations that occur; the cube's levels are built from those few
    rows. ``level`` has a bit for each column summed over (4 mode, 2 tier, 1 status), which tells a total
    from a missing value. No players give no rows. Expects churn_risk_level and spend_tier_label.
    """
    cells = df.groupBy(
        F.col(K.MODE).alias("game_mode"), F.col("spend_tier_label").alias("spend_tier"), F.col("churn_risk_level").alias("status")
    ).agg(
        F.count(F.lit(1)).alias("players"), F.count(K.LABEL).alias("labelled"), F.sum(F.col(K.LABEL).cast("bigint")).alias("churned"),
        F.sum(spend_or_zero()).alias("spend"), F.sum(num("session_count")).alias("sessions"), F.count(num("session_count")).alias("with_sessions"),
    )
    return cells.cube(*CUBE).agg(F.grouping_id().cast("bigint").alias("level"), *[F.sum(c).alias(c) for c in _ADDED])


def cube_cells(cube: DataFrame, by: str | None = None, **chosen) -> DataFrame:
    """The rows of the cube that make up a selection: {filter column: values}, apart by ``by``, over all of the rest."""
    level = sum(4 >> i for i, c in enumerate(CUBE) if c != by and chosen.get(c) is None)
    rows = cube.where(F.col("level") == level)
    for column, values in chosen.items():
        rows = rows if values is None else rows.where(F.col(column).isin(list(values)))
    return rows


def kpi_row_from_cube(cube: DataFrame, **chosen) -> DataFrame:
    """kpi_row of the selected players."""
    share = F.coalesce(ratio(F.sum("churned"), F.sum("players")), F.lit(0.0))
    return cube_cells(cube, **chosen).agg(
        F.coalesce(F.sum("players"), F.lit(0)).alias("total_players"),
        F.coalesce(F.sum("churned"), F.lit(0)).alias("churned_players"),
        round_even(share * 100.0, 1).alias("churn_rate_pct"),
        round_even(ratio(F.sum("spend"), F.sum("players")), 2).alias("avg_spend"),
        round_even(ratio(F.sum("sessions"), F.sum("with_sessions")), 0).alias("avg_sessions"),
    )


def churn_by_mode_from_cube(cube: DataFrame, **chosen) -> DataFrame:
    """churn_by_mode of the selected players."""
    rows = cube_cells(cube, "game_mode", **chosen).where(F.col("game_mode").isNotNull())
    share = ratio(F.sum("churned"), F.sum("labelled"))
    return rows.groupBy("game_mode").agg(
        share.alias("churn_rate"), F.sum("labelled").alias("player_count"), round_even(share * 100.0, 1).alias("churn_pct")
    )


def spend_tier_counts_from_cube(cube: DataFrame, **chosen) -> DataFrame:
    """spend_tier_counts of the selected players."""
    rows = cube_cells(cube, "spend_tier", **chosen).where(F.col("spend_tier").isNotNull())
    return rows.groupBy(F.col("spend_tier").alias("tier")).agg(F.sum("players").alias("players"))


def churn_by_mode(df: DataFrame) -> DataFrame:
    return df.where(F.col(K.MODE).isNotNull()).groupBy(F.col(K.MODE).alias("game_mode")).agg(
        churn_share().alias("churn_rate"),
        F.count(K.LABEL).alias("player_count"),
        churn_pct().alias("churn_pct"),
    )


def churn_by_mode_vs_overall(df: DataFrame) -> DataFrame:
    """Churn by mode with the overall rate beside it and a flag for modes above it."""
    overall = df.agg(churn_share().alias("overall_rate"))
    out = with_overall(churn_by_mode(df), overall, {"overall_rate": "overall_rate"})
    return out.withColumn("above_overall", F.col("churn_rate") > F.col("overall_rate"))


def spend_tier_counts(df: DataFrame) -> DataFrame:
    """Expects spend_tier_label."""
    return df.where(F.col("spend_tier_label").isNotNull()).groupBy(F.col("spend_tier_label").alias("tier")).agg(
        F.count(F.lit(1)).alias("players")
    )


def histogram(df: DataFrame, column: Column, bins: int, by: str | None = K.LABEL, shared: bool = False) -> DataFrame:
    """(label, bin, low, high, n, density): equal-width bins per label, or over both if ``shared``.

    Limits come from a two-row (or one-row) aggregate; the last bin is closed on the right.
    """
    rows = df.select(F.col(by).alias("label"), column.cast("double").alias("x")).where(
        F.col("x").isNotNull() & F.col("label").isNotNull()
    )
    limits = [F.min("x").alias("lo"), F.max("x").alias("hi")]
    if shared:
        span = rows.agg(*limits)
        placed = with_overall(rows, span, {"lo": "lo", "hi": "hi"})
    else:
        placed = rows.join(F.broadcast(rows.groupBy("label").agg(*limits)), "label")
    width = (F.col("hi") - F.col("lo")) / float(bins)
    counted = placed.groupBy("label", "lo", "hi", equal_width_bin(F.col("x"), F.col("lo"), F.col("hi"), bins).alias("bin")).agg(
        F.count(F.lit(1)).alias("n")
    )
    # a label's total is the sum of its few bins
    return counted.withColumn("total", F.sum("n").over(W.partitionBy("label"))).select(
        "label",
        "bin",
        (F.col("lo") + F.col("bin") * width).alias("low"),
        (F.col("lo") + (F.col("bin") + 1) * width).alias("high"),
        "n",
        ratio(F.col("n"), F.col("total") * width).alias("density"),
    )


def recency_histogram(df: DataFrame, bins: int = 50) -> DataFrame:
    """Recency histogram per label with the label's median."""
    days = histogram(df, F.col("last_login_days_ago"), bins)
    medians = quantile_rows(df, ["last_login_days_ago"], [0.5], [K.LABEL]).select(
        F.col(K.LABEL).alias("label"), F.col("quantile").alias("median")
    )
    return days.join(F.broadcast(medians), "label").drop("density")


def recency_overlay(df: DataFrame, bins: int = 60) -> DataFrame:
    """Recency histogram with bins shared by both labels."""
    return histogram(df, F.col("last_login_days_ago"), bins, shared=True).drop("density")


def session_density(df: DataFrame, cap: float = 200.0, bins: int = 60) -> DataFrame:
    return histogram(df, clip(num("session_count"), high=cap), bins)


def box_stats(df: DataFrame, columns: list[str] = K.NUMERIC_FEATURES, cap: float = 0.98) -> DataFrame:
    """Quartiles and whiskers per (feature, label) after capping at the overall ``cap`` quantile.

    Whiskers are the outermost values within 1.5 interquartile ranges of the box.
    """
    tops = collect_quantiles(df, columns, [cap])
    capped = df.select(
        K.LABEL, *[clip(num(c), high=tops[c][cap]).alias(c) if tops[c] else num(c).alias(c) for c in columns]
    )
    box = quantile_rows(capped, columns, [0.25, 0.5, 0.75], [K.LABEL]).groupBy(K.LABEL, "feature").agg(*[
        F.max(F.when(F.col("fraction") == q, F.col("quantile"))).alias(name)
        for q, name in [(0.25, "q1"), (0.5, "median"), (0.75, "q3")]
    ])
    reach = (F.col("q3") - F.col("q1")) * 1.5
    inside = (F.col("value") >= F.col("q1") - reach) & (F.col("value") <= F.col("q3") + reach)
    return (
        unpivot_numeric(capped, columns, [K.LABEL])
        .join(F.broadcast(box), [K.LABEL, "feature"])
        .groupBy("feature", F.col(K.LABEL).alias("label"), "q1", "median", "q3")
        .agg(
            F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
            F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
            F.count(F.lit(1)).alias("n"),
            count_if(~inside).alias("outliers"),
        )
    )


def churn_by_win_rate(df: DataFrame, bins: int = 10) -> DataFrame:
    """Ten equal-width win-rate bins; null counts as the median for binning only."""
    median = collect_quantiles(df, ["win_rate"], [0.5])["win_rate"].get(0.5)
    rows = df.select(K.LABEL, "win_rate", F.coalesce(num("win_rate"), F.lit(median)).alias("x"))
    span = rows.agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    placed = with_overall(rows, span, {"lo": "lo", "hi": "hi"})
    bin_id = equal_width_cut(F.col("x"), F.col("lo"), F.col("hi"), bins)
    return placed.groupBy(bin_id.alias("win_rate_bin")).agg(
        churn_share().alias("churn_rate"),
        F.count(K.LABEL).alias("n"),
        F.avg("win_rate").alias("avg_win_rate"),
    )


def quadratic_trend(points: DataFrame, x: str, y: str) -> DataFrame:
    """Least-squares a*x^2 + b*x + c from power sums, by Cramer's rule.

    x is centred on its mean first, which keeps the 3x3 system well conditioned.
    """
    xs, ys = num(x), num(y)
    both = xs.isNotNull() & ys.isNotNull()
    points = points.where(both).select(xs.alias("x0"), ys.alias("y"))
    centred = with_overall(points, points.agg(F.avg("x0").alias("m")), {"m": "m"}).withColumn("x", F.col("x0") - F.col("m"))
    power = lambda p: F.sum(F.pow("x", F.lit(float(p))))
    s = centred.agg(
        F.max("m").alias("m"),
        F.count(F.lit(1)).cast("double").alias("s0"),
        power(1).alias("s1"), power(2).alias("s2"), power(3).alias("s3"), power(4).alias("s4"),
        F.sum("y").alias("t0"),
        F.sum(F.col("x") * F.col("y")).alias("t1"),
        F.sum(F.col("x") * F.col("x") * F.col("y")).alias("t2"),
    )
    s0, s1, s2, s3, s4, t0, t1, t2 = (F.col(c) for c in ("s0", "s1", "s2", "s3", "s4", "t0", "t1", "t2"))

    def det(a, b, c, d, e, f, g, h, i):
        return a * (e * i - f * h) - b * (d * i - f * g) + c * (d * h - e * g)

    base = det(s4, s3, s2, s3, s2, s1, s2, s1, s0)
    solved = s.select(
        "m",
        F.try_divide(det(t2, s3, s2, t1, s2, s1, t0, s1, s0), base).alias("a"),
        F.try_divide(det(s4, t2, s2, s3, t1, s1, s2, t0, s0), base).alias("b"),
        F.try_divide(det(s4, s3, t2, s3, s2, t1, s2, s1, t0), base).alias("c"),
    )
    a, b, c, m = (F.col(k) for k in ("a", "b", "c", "m"))
    return solved.select(a.alias("a2"), (b - 2.0 * a * m).alias("a1"), (a * m * m - b * m + c).alias("a0"))


def win_rate_trend_line(df: DataFrame) -> DataFrame:
    points = churn_by_win_rate(df).withColumn("churn_pct", F.col("churn_rate") * 100.0)
    return quadratic_trend(points, "avg_win_rate", "churn_pct")


def log_spend_summary(df: DataFrame) -> DataFrame:
    """(label, n, low, median, high) of log1p(spend, null as 0)."""
    logged = df.select(F.col(K.LABEL).alias("label"), F.log1p(spend_or_zero()).alias("log_spend"))
    middle = quantile_rows(logged, ["log_spend"], [0.5], ["label"]).select("label", F.col("quantile").alias("median"))
    return logged.groupBy("label").agg(
        F.count(F.lit(1)).alias("n"), F.min("log_spend").alias("low"), F.max("log_spend").alias("high")
    ).join(F.broadcast(middle), "label")


def log_spend_density(df: DataFrame, bins: int = 50) -> DataFrame:
    return histogram(df, F.log1p(spend_or_zero()), bins)


def churn_mode_by_losses(df: DataFrame) -> DataFrame:
    """Churn % by mode (rows) and loss bin (columns); an empty cell is null."""
    edges, names = K.LOSS_BINS
    binned = df.select(
        F.col(K.MODE).alias("game_mode"), K.LABEL, right_closed_bin(F.col("consecutive_losses"), edges, names).alias("bin")
    ).where(F.col("game_mode").isNotNull() & F.col("bin").isNotNull())
    return binned.groupBy("game_mode").pivot("bin", names).agg(churn_share() * 100.0)


def churn_by_friends(df: DataFrame) -> DataFrame:
    """Churn by friend-count bin, null as 0; bins without players stay with a count of 0."""
    edges, names = K.FRIEND_BINS
    binned = df.select(
        K.LABEL, right_closed_bin(F.coalesce(num("friend_count"), F.lit(0.0)), edges, names).alias("friend_bin")
    )
    found = binned.groupBy("friend_bin").agg(churn_share().alias("churn_rate"), F.count(K.LABEL).alias("n"))
    every = df.sparkSession.createDataFrame(list(enumerate(names)), "bin_order int, friend_bin string")
    return every.join(F.broadcast(found), "friend_bin", "left").select(
        "friend_bin", "churn_rate", F.coalesce("n", F.lit(0)).alias("n"), (F.col("churn_rate") * 100.0).alias("churn_pct")
    )


def correlation_pairs(df: DataFrame, columns: list[str]) -> DataFrame:
    """(row_feature, col_feature, corr) below the diagonal, all pairs in one aggregate.

    Each pair uses the rows where both values are present.
    """
    pairs = [(columns[i], columns[j]) for i in range(len(columns)) for j in range(i)]
    typed = df.select(*[num(c).alias(c) for c in columns])
    one = typed.agg(*[F.corr(a, b).alias(f"p{k}") for k, (a, b) in enumerate(pairs)])
    rows = F.array(*[
        F.struct(F.lit(a).alias("row_feature"), F.lit(b).alias("col_feature"), F.col(f"p{k}").alias("corr"))
        for k, (a, b) in enumerate(pairs)
    ])
    return one.select(F.inline(rows))


def top_churn_correlations(df: DataFrame, n: int = 5) -> DataFrame:
    pairs = correlation_pairs(df, K.NUMERIC_FEATURES + [K.LABEL]).where(F.col("row_feature") == K.LABEL)
    return pairs.select(F.col("col_feature").alias("feature"), F.abs("corr").alias("abs_corr")).orderBy(
        F.desc("abs_corr"), "feature"
    ).limit(n)


def cohort_retention(df: DataFrame, first: int | None = None) -> DataFrame:
    """(join_month, total, retained, retention_rate) of all months, or of the earliest ones if asked."""
    months = df.groupBy(F.date_format("join_date", "yyyy-MM").alias("join_month")).agg(
        F.count(F.lit(1)).alias("total"), count_if(F.col(K.LABEL) == 0).alias("retained")
    ).withColumn(
        "retention_rate", round_even(F.col("retained") / F.col("total") * 100.0, 1)
    ).orderBy("join_month")
    return months if first is None else months.limit(first)


def engagement_funnel(df: DataFrame) -> DataFrame:
    """Five independent conditions (a player may meet a later one without an earlier one)."""
    stages = {
        "All Players": F.lit(True),
        "5+ Sessions": num("session_count") >= 5,
        "10+ Achievements": num("achievement_count") >= 10,
        "First Purchase": spend_or_zero() > 0,
        "Spent $10+": spend_or_zero() >= 10,
    }
    names = list(stages)
    counts = df.agg(*[count_if(rule).alias(name) for name, rule in stages.items()])
    every = counts.select("*", F.col(names[0]).alias("_all"))
    return every.unpivot(["_all"], [F.col(f"`{n}`") for n in names], "stage", "players").select(
        "stage", "players", round_even(ratio(F.col("players"), F.col("_all")) * 100.0, 1).alias("pct")
    )


def spend_by_mode_and_status(df: DataFrame) -> DataFrame:
    return df.where(F.col(K.MODE).isNotNull()).groupBy(F.col(K.MODE).alias("game_mode")).pivot(K.LABEL, [0, 1]).agg(
        F.avg(num(SPEND))
    ).withColumnsRenamed({"0": "Active", "1": "Churned"})


def segment_counts(df: DataFrame) -> DataFrame:
    return df.where(F.col("segment").isNotNull()).groupBy("segment").agg(F.count(F.lit(1)).alias("players"))


def segment_profile(df: DataFrame, columns: list[str] = K.PROFILE_FEATURES) -> DataFrame:
    """Mean and median per column, player count, churn % and the strategy text of each segment."""
    known = df.where(F.col("segment").isNotNull())
    have = [c for c in columns if c in df.columns]
    means = known.groupBy("segment").agg(
        *[round_even(F.avg(num(c)), 2).alias(f"{c}_mean") for c in have],
        F.count(F.lit(1)).alias("player_count"),
        churn_pct().alias("churn_rate_pct"),
    )
    medians = quantile_rows(known, have, [0.5], ["segment"]).groupBy("segment").agg(*[
        round_even(F.max(F.when(F.col("feature") == c, F.col("quantile"))), 2).alias(f"{c}_median") for c in have
    ])
    ordered = [f"{c}_{kind}" for c in have for kind in ("mean", "median")]
    joined = means.join(F.broadcast(medians), "segment")
    return with_constant_map(joined, "segment", K.RETENTION_STRATEGIES, "retention_strategy").select(
        "segment", *ordered, "player_count", "churn_rate_pct", "retention_strategy"
    )


def churn_by_segment(df: DataFrame) -> DataFrame:
    return df.where(F.col("segment").isNotNull()).groupBy("segment").agg(
        churn_share().alias("churn_rate"), churn_pct().alias("churn_pct")
    )


def segment_cards(df: DataFrame) -> DataFrame:
    """Count, churn % and average spend of the four segments; a missing segment has count 0."""
    found = df.groupBy("segment").agg(
        F.count(F.lit(1)).alias("players"),
        churn_pct().alias("churn_pct"),
        round_even(F.avg(spend_or_zero()), 0).alias("avg_spend"),
    )
    every = df.sparkSession.createDataFrame([(s,) for s in K.SEGMENTS], "segment string")
    return every.join(F.broadcast(found), "segment", "left").withColumn("players", F.coalesce("players", F.lit(0)))


def segment_radar(profile: DataFrame, features: list[str] = K.RADAR_FEATURES) -> DataFrame:
    """(segment, metric, value): each mean divided by the largest mean of any segment."""
    have = [f"{c}_mean" for c in features if f"{c}_mean" in profile.columns]
    tops = profile.agg(*[F.max(c).alias(c) for c in have])
    out = profile.select(
        "segment", *[(F.col(c) / (tops.select(c).scalar() + 1e-8)).alias(c) for c in have]
    )
    title = F.initcap(F.replace(F.replace(F.col("metric"), F.lit("_mean"), F.lit("")), F.lit("_"), F.lit(" ")))
    return out.unpivot(["segment"], have, "metric", "value").withColumn("metric", title)
