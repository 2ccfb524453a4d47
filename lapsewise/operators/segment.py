"""K-Means segments: fit, quality, naming, projection.

All starts of a fit, for one number of clusters or several, advance together: an iteration is one pass over the
rows that sums them up by the nearest centre of each start, and only those sums reach the driver. A start drops
out when its centres stay; the passes are as many as the slowest start needs.
"""

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapsewise import constants as K
from lapsewise.functions.numeric import num
from lapsewise.operators.clean import assemble, fill_constants, fit_median, fit_scale, scaled
from lapsewise.operators.joins import with_constant_map, with_overall
from lapsewise.operators.ranks import seeded_sample
from lapsewise.sources.tables import available
from lapsewise.sources.workspace import materialise

# helpers of this module travel with the job; executors do not need the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Rows, those with the smallest hash, from which k-means++ draws the first centres; all rows take part from then on.
START_ROWS = 4096
#: A start stops when no centre moves farther.
STAYS = 1e-4
#: Rows compared with the centres at once.
TOGETHER = 2048


@dataclass
class Centres:
    """The centres of one start, the summed squared distance to the nearest one, and the passes that it took."""

    centres: np.ndarray
    cost: float
    passes: int

    def clusterCenters(self) -> list[np.ndarray]:  # noqa: N802 (named as the library's models do)
        return list(self.centres)

    def save(self, spark, path: str) -> None:
        rows = [(i, [float(x) for x in c], float(self.cost), self.passes) for i, c in enumerate(self.centres)]
        spark.createDataFrame(rows, "cluster_id int, centre array<double>, cost double, passes int").coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark, path: str) -> "Centres":
        rows = spark.read.parquet(path).orderBy("cluster_id").collect()
        return cls(np.array([r["centre"] for r in rows]), rows[0]["cost"], rows[0]["passes"])


@dataclass
class Segmenter:
    """What assigning players needs: the statistics of the fit, the model, and a name for each cluster."""

    features: list[str]
    medians: dict[str, float]
    scales: dict[str, tuple[float, float]]
    model: Centres | None = None
    names: dict[int, str] | None = None

    @classmethod
    def statistics(cls, df: DataFrame, columns: list[str] = K.CLUSTER_FEATURES) -> "Segmenter":
        """Medians, means and deviations of the columns that the table has; absent ones are skipped."""
        have = available(df, list(columns))
        rows = df.select(*[num(c).alias(c) for c in have])
        medians = {c: v for c, v in fit_median(rows, have).items() if v is not None}
        return cls(have, medians, fit_scale(fill_constants(rows, medians), have))

    def matrix(self, df: DataFrame, keep: list[str] = (K.ID,)) -> DataFrame:
        """Imputed and scaled columns, by the statistics of the fit."""
        rows = fill_constants(df.select(*keep, *[num(c).alias(c) for c in self.features]), self.medians)
        return rows.select(*keep, *[scaled(c, *self.scales[c]).alias(c) if c in self.scales else F.col(c) for c in self.features])

    def segments(self, df: DataFrame, key: str = K.ID) -> DataFrame:
        """(key, cluster_id, segment) of any players, also of ones that the fit hasn't seen."""
        assigned = assign(self.matrix(df, [key]), self.features, self.model).select(key, "cluster_id")
        return with_constant_map(assigned, "cluster_id", self.names, "segment")

    def save(self, spark, path: str) -> str:
        self.model.save(spark, f"{path}/model")
        rows = [(i, c, self.medians.get(c), *self.scales.get(c, (None, None))) for i, c in enumerate(self.features)]
        spark.createDataFrame(rows, "place int, feature string, median double, mean double, deviation double").coalesce(1).write.mode(
            "overwrite"
        ).parquet(f"{path}/statistics")
        spark.createDataFrame(sorted(self.names.items()), "cluster_id int, segment string").coalesce(1).write.mode("overwrite").parquet(f"{path}/names")
        return path

    @classmethod
    def load(cls, spark, path: str) -> "Segmenter":
        rows = spark.read.parquet(f"{path}/statistics").orderBy("place").collect()
        return cls(
            [r["feature"] for r in rows],
            {r["feature"]: r["median"] for r in rows if r["median"] is not None},
            {r["feature"]: (r["mean"], r["deviation"]) for r in rows if r["mean"] is not None},
            Centres.load(spark, f"{path}/model"),
            {r["cluster_id"]: r["segment"] for r in spark.read.parquet(f"{path}/names").collect()},
        )


def cluster_matrix(df: DataFrame, columns: list[str] = K.CLUSTER_FEATURES, keep: list[str] = (K.ID,)) -> tuple[DataFrame, list[str]]:
    """Median-imputed, scaled columns that the table has; absent ones are skipped."""
    fitted = Segmenter.statistics(df, columns)
    return fitted.matrix(df, list(keep)), fitted.features


def first_centres(sample: np.ndarray, k: int, seed: int) -> np.ndarray:
    """k-means++: each further centre is a row drawn by its squared distance to the nearest one; fewer if rows are equal."""
    rng = np.random.default_rng(seed)
    centres = [sample[rng.integers(len(sample))]]
    away = ((sample - centres[0]) ** 2).sum(1)
    while len(centres) < k and away.sum() > 0:
        centres.append(sample[rng.choice(len(sample), p=away / away.sum())])
        away = np.minimum(away, ((sample - centres[-1]) ** 2).sum(1))
    return np.array(centres)


def nearest_sums(starts: list[np.ndarray], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each centre of each start, numbered through: how many rows are nearest to it, their sums and their squared distances."""
    centres = np.concatenate(starts)
    edge = np.cumsum([0, *map(len, starts)])
    n, sums, cost = np.zeros(len(centres), np.int64), np.zeros(centres.shape), np.zeros(len(centres))
    norms = (centres**2).sum(1)
    for batch in batches:
        rows = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, centres.shape[1])
        for at in range(0, len(rows), TOGETHER):
            x = rows[at : at + TOGETHER]
            away = norms - 2 * x @ centres.T + (x**2).sum(1)[:, None]
            for low, high in zip(edge, edge[1:]):
                near = away[:, low:high].argmin(1)
                own = np.zeros((len(x), high - low))
                own[np.arange(len(x)), near] = 1
                n[low:high] += own.sum(0).astype(np.int64)
                sums[low:high] += own.T @ x
                cost[low:high] += own.T @ np.maximum(away[np.arange(len(x)), low + near], 0)
    lists = pa.ListArray.from_arrays(pa.array(np.arange(len(centres) + 1) * centres.shape[1], pa.int32()), pa.array(sums.ravel()))
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(centres))), pa.array(n), lists, pa.array(cost)], names=["centre", "n", "sums", "cost"])


def fit_starts(
    matrix: DataFrame, features: list[str], ks: list[int], restarts: int = 20, max_iter: int = 500, seed: int = 42
) -> dict[int, Centres]:
    """For each k the best of several seeded starts, by cost; the first one on ties.

    The driver holds the centres of all starts and, once, START_ROWS rows. The matrix has no nulls.
    """
    rows = materialise(matrix.select(F.array(*[num(c) for c in features]).alias("x")), "points")
    sample = np.array([r["x"] for r in rows.orderBy(F.xxhash64("x"), "x").limit(START_ROWS).collect()])
    if not len(sample):
        raise ValueError("no rows to cluster")
    now = {(k, turn): first_centres(sample, k, seed + turn) for k in ks for turn in range(restarts)}
    done: dict[tuple, Centres] = {}
    added = F.expr(f"array({', '.join(f'sum(sums[{i}])' for i in range(len(features)))})").alias("sums")
    passes = 0
    while now:
        passes += 1
        names, starts = list(now), list(now.values())

        def sums(batches: Iterator[pa.RecordBatch], starts=starts) -> Iterator[pa.RecordBatch]:
            return nearest_sums(starts, batches)

        each = rows.mapInArrow(sums, "centre long, n long, sums array<double>, cost double")
        total = each.groupBy("centre").agg(F.sum("n").alias("n"), added, F.sum("cost").alias("cost"))
        found = {r["centre"]: r for r in total.collect()}
        at = 0
        for name, centres in zip(names, starts):
            own = [found[at + i] for i in range(len(centres))]
            at += len(centres)
            moved = np.array([np.array(r["sums"]) / r["n"] if r["n"] else c for r, c in zip(own, centres)])
            if passes >= max_iter or ((moved - centres) ** 2).sum(1).max() <= STAYS**2:
                done[name] = Centres(centres, sum(r["cost"] for r in own), passes)
                del now[name]
            else:
                now[name] = moved
    return {k: min((done[k, turn] for turn in range(restarts)), key=lambda m: m.cost) for k in ks}


def fit_kmeans(matrix: DataFrame, features: list[str], k: int = 4, restarts: int = 20, max_iter: int = 500, seed: int = 42) -> Centres:
    """Best of several seeded starts by within-cluster cost."""
    return fit_starts(matrix, features, [k], restarts, max_iter, seed)[k]


def assign(matrix: DataFrame, features: list[str], model: Centres) -> DataFrame:
    """Matrix with cluster_id: the nearest centre, the smallest id on ties."""
    away = F.array(*[sum((num(c) - F.lit(float(x))) ** 2 for c, x in zip(features, centre)) for centre in model.centres])
    return matrix.withColumn("cluster_id", (F.array_position(away, F.array_min(away)) - 1).cast("int"))


def centroid_table(model: Centres, spark, features: list[str]) -> DataFrame:
    """(cluster_id, features...): k rows."""
    rows = [(i, *[float(x) for x in c]) for i, c in enumerate(model.clusterCenters())]
    return spark.createDataFrame(rows, ", ".join(["cluster_id int", *[f"`{f}` double" for f in features]]))


def name_clusters(centroids: DataFrame) -> DataFrame:
    """(cluster_id, segment) from a centroid table.

    Highest spend is Whales; of the others the highest days since login is At-Risk; of the rest
    the most sessions is Champions; what is left is Casual. Choosing At-Risk among the clusters
    that are not Whales gives four names even when one cluster leads in both. The lowest id wins
    ties.
    """
    def pick(rows, column):
        return rows.agg(
            F.max_by("cluster_id", F.struct(F.col(column), -F.col("cluster_id"))).alias("id")
        ).scalar()

    whales = pick(centroids, "total_spend_usd")
    marked = centroids.withColumn("segment", F.when(F.col("cluster_id") == whales, F.lit("Whales")))
    at_risk = pick(marked.where(F.col("segment").isNull()), "last_login_days_ago")
    marked = marked.withColumn(
        "segment", F.coalesce("segment", F.when(F.col("cluster_id") == at_risk, F.lit("At-Risk")))
    )
    champions = pick(marked.where(F.col("segment").isNull()), "session_count")
    return marked.select(
        "cluster_id",
        F.coalesce(
            "segment", F.when(F.col("cluster_id") == champions, F.lit("Champions")), F.lit("Casual")
        ).alias("segment"),
    )


def fit_segmenter(df: DataFrame, k: int = 4, restarts: int = 20, max_iter: int = 500, seed: int = 42) -> Segmenter:
    """Statistics, clusters and their names; k names reach the driver."""
    fitted = Segmenter.statistics(df)
    matrix = materialise(fitted.matrix(df), "clusters")
    fitted.model = fit_kmeans(matrix, fitted.features, k, restarts, max_iter, seed)
    names = name_clusters(centroid_table(fitted.model, df.sparkSession, fitted.features))
    fitted.names = {r["cluster_id"]: r["segment"] for r in names.collect()}
    return fitted


def segment_players(
    df: DataFrame, k: int = 4, restarts: int = 20, max_iter: int = 500, seed: int = 42
) -> tuple[DataFrame, Centres, list[str]]:
    """The whole step: matrix, fit, assignment, names."""
    fitted = fit_segmenter(df, k, restarts, max_iter, seed)
    return df.join(fitted.segments(df), K.ID), fitted.model, fitted.features


def scan_k(
    matrix: DataFrame, features: list[str], ks: range = range(2, 9), restarts: int = 10, seed: int = 42
) -> DataFrame:
    """(k, inertia, silhouette, best): whole-data silhouette on squared Euclidean distance.

    The scan reports the best k; segmentation itself keeps k = 4.
    """
    models = fit_starts(matrix, features, list(ks), restarts, seed=seed)
    rows = [(k, float(m.cost), squared_silhouette(assign(matrix, features, m), features)) for k, m in models.items()]
    best = max(rows, key=lambda r: (r[2], -r[0]))[0]
    return matrix.sparkSession.createDataFrame(
        [(*r, r[0] == best) for r in rows], "k int, inertia double, silhouette double, best boolean"
    )


def squared_silhouette(assigned: DataFrame, features: list[str]) -> float:
    """Silhouette on squared Euclidean distance, all rows, linear time."""
    return float(
        ClusteringEvaluator(predictionCol="cluster_id", featuresCol="features").evaluate(assemble(assigned, features))
    )


def silhouette_by_cluster(assigned: DataFrame, features: list[str]) -> DataFrame:
    """(cluster_id, n, silhouette) on squared Euclidean distance, from all rows.

    The mean squared distance from a point to a cluster follows from the cluster's count, centre
    and mean squared norm, so one pass gathers a row per cluster and a second one places each point.
    A point alone in its cluster, or the points of a single cluster, count 0.
    """
    point = F.array(*[num(c) for c in features])

    def dot(a, b):
        return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)

    rows = assigned.select("cluster_id", point.alias("x")).withColumn("norm", dot(F.col("x"), F.col("x")))
    clusters = rows.groupBy("cluster_id").agg(
        F.count(F.lit(1)).alias("n"), F.array(*[F.avg(F.col("x")[i]) for i in range(len(features))]).alias("centre"), F.avg("norm").alias("norm")
    )
    listed = clusters.agg(F.collect_list(F.struct("cluster_id", "n", "centre", "norm")).alias("all"))
    placed = with_overall(rows, listed, {"all": "all"})
    away = F.transform("all", lambda c: F.struct(
        c["cluster_id"].alias("cluster_id"), c["n"].alias("n"),
        F.greatest(F.col("norm") - 2.0 * dot(F.col("x"), c["centre"]) + c["norm"], F.lit(0.0)).alias("d"),
    ))
    placed = placed.select("cluster_id", away.alias("away"))
    own = F.filter("away", lambda c: c["cluster_id"] == F.col("cluster_id"))[0]
    other = F.array_min(F.transform(F.filter("away", lambda c: c["cluster_id"] != F.col("cluster_id")), lambda c: c["d"]))
    near = F.when(own["n"] > 1, own["d"] * own["n"] / (own["n"] - 1))
    each = placed.select("cluster_id", near.alias("near"), other.alias("other"))
    value = F.coalesce(F.try_divide(F.col("other") - F.col("near"), F.greatest("near", "other")), F.lit(0.0))
    return each.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("n"), F.avg(F.when(F.col("near").isNull(), 0.0).otherwise(value)).alias("silhouette"))


def davies_bouldin(assigned: DataFrame, features: list[str]) -> DataFrame:
    """One row. Centroids and spreads have k rows; pairs of clusters are formed from one array."""
    centres = assigned.groupBy("cluster_id").agg(F.array(*[F.avg(c) for c in features]).alias("centre"))

    def distance(a, b):
        return F.sqrt(F.aggregate(
            F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda acc, x: acc + x
        ))

    spread = (
        assigned.join(F.broadcast(centres), "cluster_id")
        .withColumn("d", distance(F.array(*[num(c) for c in features]), F.col("centre")))
        .groupBy("cluster_id", "centre")
        .agg(F.avg("d").alias("s"))
    )
    listed = spread.agg(F.collect_list(F.struct("cluster_id", "centre", "s")).alias("all"))
    worst = F.transform(
        "all",
        lambda a: F.array_max(F.transform(
            F.filter("all", lambda b: b["cluster_id"] != a["cluster_id"]),
            lambda b: F.try_divide(a["s"] + b["s"], distance(a["centre"], b["centre"])),
        )),
    )
    return listed.select(F.explode(worst).alias("worst")).agg(F.avg("worst").alias("davies_bouldin"))


def project_2d(matrix: DataFrame, features: list[str], keep: list[str] = (K.ID,)) -> tuple[DataFrame, float]:
    """(keep..., PC1, PC2) and the explained variance in percent.

    Each component's sign is chosen so that its largest loading is positive.
    """
    ready = assemble(matrix, features)
    model = PCA(k=2, inputCol="features", outputCol="pc").fit(ready)
    loadings = model.pc.toArray()
    signs = [1.0 if loadings[np.abs(loadings[:, j]).argmax(), j] >= 0 else -1.0 for j in range(2)]
    at = vector_to_array("pc")
    points = model.transform(ready).select(
        *keep, (at[0] * signs[0]).alias("PC1"), (at[1] * signs[1]).alias("PC2")
    )
    return points, float(sum(model.explainedVariance) * 100.0)


def fallback_scatter(df: DataFrame, n: int | None = None, key: str = K.ID, seed: int = 42) -> DataFrame:
    """Engagement against RFM score of all players, or of a seeded sample if asked."""
    wanted = [key, "engagement_score", "rfm_score", "segment", "session_count", "total_spend_usd", "win_rate"]
    return (df if n is None else seeded_sample(df, key, n, seed)).select(*available(df, wanted))
