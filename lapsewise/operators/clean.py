"""Cleaning and preprocessing.

Operators that need statistics are split in two: ``fit_*`` runs one distributed job and brings a
bounded number of statistics to the driver, ``apply``/``transform`` is a plain projection with
these values as literals, so it fuses with whatever comes before and after it.
"""

from dataclasses import dataclass, field

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lapsewise import constants as K
from lapsewise.functions.labels import churn_status, spend_tier_from_amount, spend_tier_label
from lapsewise.functions.numeric import all_of, clip, count_if, num, round_even
from lapsewise.operators.brackets import collect_quantiles, quantile_rows
from lapsewise.operators.ranks import unpivot_numeric
from lapsewise.sources.tables import available

MAX_CATEGORIES = 1000


def remove_duplicates(df: DataFrame, key: str, order: str) -> DataFrame:
    """Keep the row with the smallest ``order`` per key; null comes last, ties go by the other columns.

    A min aggregate combines on the map side, so a key with very many copies sends one row per
    task instead of all its copies to one window partition.
    """
    rest = [c for c in df.columns if c not in (key, order)]
    first = F.min(F.struct(F.col(order).isNull().alias("_last"), order, *rest)).alias("_first")
    return df.groupBy(key).agg(first).select(*(F.col(c if c == key else f"_first.`{c}`").alias(c) for c in df.columns))


def duplicate_count(df: DataFrame, key: str) -> DataFrame:
    """One row: rows, distinct keys, rows that remove_duplicates drops."""
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.count(F.lit(1)).alias("kept"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("removed"),
    )


def fit_winsor(df: DataFrame, columns: list[str], lower: float = 0.01, upper: float = 0.99) -> dict:
    """{column: (low, high)}; a column whose two quantiles coincide (or that is empty) is left out."""
    found = collect_quantiles(df, columns, [lower, upper])
    limits = {}
    for column in columns:
        if found[column]:
            low, high = found[column][lower], found[column][upper]
            if low != high:
                limits[column] = (low, high)
    return limits


def apply_winsor(df: DataFrame, limits: dict) -> DataFrame:
    """Clip to the fitted limits; clipped columns become double."""
    return df.select([
        clip(num(c), *limits[c]).alias(c) if c in limits else F.col(c) for c in df.columns
    ])


def winsorise(df: DataFrame, columns: list[str], lower: float = 0.01, upper: float = 0.99) -> DataFrame:
    return apply_winsor(df, fit_winsor(df, columns, lower, upper))


def winsor_report(df: DataFrame, limits: dict) -> DataFrame:
    """(feature, low, high, clipped): how many values each limit changes, nulls not counted."""
    counts = df.agg(*[
        count_if((num(c) < F.lit(low)) | (num(c) > F.lit(high))).alias(c)
        for c, (low, high) in limits.items()
    ])
    rows = F.array(*[
        F.struct(F.lit(c).alias("feature"), F.lit(low).alias("low"), F.lit(high).alias("high"),
                 F.col(c).alias("clipped"))
        for c, (low, high) in limits.items()
    ])
    return counts.select(F.inline(rows))


def null_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(column, nulls) for columns with at least one null."""
    names = columns or df.columns
    counts = df.agg(*[count_if(F.col(c).isNull()).alias(c) for c in names])
    return counts.unpivot([], names, "column", "nulls").where("nulls > 0")


def fill_constants(df: DataFrame, fills: dict[str, float]) -> DataFrame:
    return df.select([
        F.coalesce(num(c), F.lit(float(fills[c]))).alias(c) if c in fills else F.col(c) for c in df.columns
    ])


def fit_median(df: DataFrame, columns: list[str]) -> dict[str, float]:
    found = collect_quantiles(df, columns, [0.5])
    return {c: found[c].get(0.5) for c in columns}


def impute_median(df: DataFrame, columns: list[str]) -> DataFrame:
    medians = {c: v for c, v in fit_median(df, columns).items() if v is not None}
    return fill_constants(df, medians)


def column_mode(df: DataFrame, column: str) -> DataFrame:
    """Most frequent non-null value, the smallest one on ties."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), F.asc(column)).limit(1)


def impute_mode(df: DataFrame, column: str) -> DataFrame:
    mode = column_mode(df, column).select(column).scalar()
    return df.withColumn(column, F.coalesce(F.col(column), mode))


def fit_scale(df: DataFrame, columns: list[str]) -> dict[str, tuple[float, float]]:
    """{column: (mean, population std)}; a zero std is replaced by 1."""
    row = df.agg(*[
        x for c in columns
        for x in (F.avg(num(c)).alias(f"{c}_mean"), F.stddev_pop(num(c)).alias(f"{c}_std"))
    ]).first()
    return {c: (row[f"{c}_mean"] or 0.0, row[f"{c}_std"] or 1.0) for c in columns}


def scaled(column: str, mean: float, std: float) -> Column:
    return (num(column) - F.lit(mean)) / F.lit(std)


def standard_scale(df: DataFrame, columns: list[str]) -> DataFrame:
    fitted = fit_scale(df, columns)
    return df.select([scaled(c, *fitted[c]).alias(c) if c in fitted else F.col(c) for c in df.columns])


def fit_categories(df: DataFrame, column: str) -> list[str]:
    """Sorted category list; raises when the column is not categorical in size."""
    rows = df.where(F.col(column).isNotNull()).select(column).distinct().limit(MAX_CATEGORIES + 1).collect()
    if len(rows) > MAX_CATEGORIES:
        raise ValueError(f"{column} has more than {MAX_CATEGORIES} values; not a category")
    return sorted(r[0] for r in rows)


def one_hot(column: str, categories: list[str]) -> list[Column]:
    """Indicators of all categories but the first; an unknown or null value gives all zeros."""
    return [
        F.when(F.col(column) == c, F.lit(1.0)).otherwise(F.lit(0.0)).alias(f"{column}_{c}")
        for c in categories[1:]
    ]


@dataclass
class Preprocessor:
    """Median impute + scale for numeric columns, mode impute + one-hot for the category."""

    numeric: list[str]
    category: str = K.MODE
    medians: dict = field(default_factory=dict)
    scales: dict = field(default_factory=dict)
    mode: str | None = None
    categories: list = field(default_factory=list)

    def fit(self, df: DataFrame) -> "Preprocessor":
        self.medians = {c: v for c, v in fit_median(df, self.numeric).items() if v is not None}
        self.scales = fit_scale(fill_constants(df, self.medians), self.numeric)
        top = column_mode(df, self.category).first()
        self.mode = top[0] if top else None
        self.categories = fit_categories(df, self.category)
        return self

    @property
    def feature_names(self) -> list[str]:
        return self.numeric + [f"{self.category}_{c}" for c in self.categories[1:]]

    def transform(self, df: DataFrame, keep: list[str] = (K.ID, K.LABEL)) -> DataFrame:
        """keep columns, then scaled numerics, then indicators; everything else is dropped."""
        kept = available(df, list(keep))
        # the kept columns travel under another name, because a feature may be called the same
        held = [F.col(c).alias(f"_keep_{c}") for c in kept]
        complete = fill_constants(df, self.medians).withColumn(
            self.category, F.coalesce(F.col(self.category), F.lit(self.mode))
        )
        return complete.select(
            *held,
            *[scaled(c, *self.scales[c]).alias(c) for c in self.numeric],
            *one_hot(self.category, self.categories),
        ).select(*[F.col(f"_keep_{c}").alias(c) for c in kept], *self.feature_names)

    def vectors(self, df: DataFrame, keep: list[str] = (K.ID, K.LABEL)) -> DataFrame:
        return assemble(self.transform(df, keep), self.feature_names)

    SCHEMA = "kind string, name string, position int, text string, a double, b double"

    def to_frame(self, spark: SparkSession) -> DataFrame:
        rows = [("numeric", c, i, None, self.medians.get(c), None) for i, c in enumerate(self.numeric)]
        rows += [("scale", c, i, None, *self.scales[c]) for i, c in enumerate(self.numeric)]
        rows += [("category", self.category, i, c, None, None) for i, c in enumerate(self.categories)]
        rows += [("mode", self.category, 0, self.mode, None, None)]
        return spark.createDataFrame(rows, self.SCHEMA)

    def save(self, spark: SparkSession, path: str) -> str:
        self.to_frame(spark).coalesce(1).write.mode("overwrite").parquet(path)
        return path

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "Preprocessor":
        rows = sorted(spark.read.schema(cls.SCHEMA).parquet(path).collect(), key=lambda r: r["position"])
        kind = lambda k: [r for r in rows if r["kind"] == k]
        return cls(
            numeric=[r["name"] for r in kind("numeric")],
            category=kind("mode")[0]["name"],
            medians={r["name"]: r["a"] for r in kind("numeric") if r["a"] is not None},
            scales={r["name"]: (r["a"], r["b"]) for r in kind("scale")},
            mode=kind("mode")[0]["text"],
            categories=[r["text"] for r in kind("category")],
        )


def assemble(df: DataFrame, features: list[str], name: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=features, outputCol=name).transform(df)


def with_display_columns(df: DataFrame) -> DataFrame:
    """Add churn_risk_level and spend_tier_label (from the tier column if there is one)."""
    tier = (
        spend_tier_label(F.col("monetisation_tier"))
        if "monetisation_tier" in df.columns
        else spend_tier_from_amount(F.col("total_spend_usd"))
    )
    status = F.col("churn_risk_level") if "churn_risk_level" in df.columns else churn_status()
    rest = [c for c in df.columns if c not in ("churn_risk_level", "spend_tier_label")]
    return df.select(*rest, status.alias("churn_risk_level"), tier.alias("spend_tier_label"))


def board_filter(
    df: DataFrame,
    modes: list[str] | None = None,
    statuses: list[str] | None = None,
    tiers: list[str] | None = None,
) -> DataFrame:
    """Rows whose mode, status and spend tier are all selected; None selects every non-null value."""
    shown = with_display_columns(df)
    checks = []
    for name, chosen in [(K.MODE, modes), ("churn_risk_level", statuses), ("spend_tier_label", tiers)]:
        checks.append(F.col(name).isNotNull() if chosen is None else F.col(name).isin(list(chosen)))
    return shown.where(all_of(checks))


def membership(df: DataFrame, chosen: DataFrame, on: str) -> DataFrame:
    """Rows whose key is in another table."""
    return df.join(chosen.select(on), on, "left_semi")


def project(df: DataFrame, wanted: list[str]) -> DataFrame:
    return df.select(*available(df, wanted))


def describe(df: DataFrame, columns: list[str], digits: int | None = None) -> DataFrame:
    """(feature, count, mean, std, min, p25, p50, p75, max): sample std, exact quantiles."""
    long = unpivot_numeric(df, columns)
    basic = long.groupBy("feature").agg(
        F.count("value").alias("count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    quarter = quantile_rows(df, columns, [0.25, 0.5, 0.75]).groupBy("feature").agg(*[
        F.max(F.when(F.col("fraction") == q, F.col("quantile"))).alias(name)
        for q, name in [(0.25, "p25"), (0.5, "p50"), (0.75, "p75")]
    ])
    out = basic.join(F.broadcast(quarter), "feature")
    names = ["mean", "std", "min", "p25", "p50", "p75", "max"]
    cells = [round_even(F.col(c), digits).alias(c) if digits is not None else F.col(c) for c in names]
    return out.select("feature", "count", *cells)

