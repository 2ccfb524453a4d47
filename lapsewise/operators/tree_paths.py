"""Attributions of tree ensembles from the tables that a stored model consists of.

A model is stored once; its nodes are a Parquet table. Joining children to their parents, level by
level, turns it into one row for each root-to-leaf path: the interval that each feature must lie in, the share of the
training rows that each feature's splits keep, and the leaf's output. No node passes through the driver's gateway.

A path's Shapley value for feature i, with o = 1 where a row lies in the feature's interval, is

    output * (o_i - share_i) * integral over x in (0, 1) of prod over j != i of (share_j * (1 - x) + o_j * x)

since s! (u - s - 1)! / u! is the integral of x^s (1 - x)^(u - s - 1). The integrand is a polynomial of degree u - 1, so
Gauss-Legendre quadrature of u / 2 points is exact. Paths of one length are handled together as arrays.
"""

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapsewise import constants as K
from lapsewise.functions.numeric import num
from lapsewise.sources.workspace import materialise, new_path

# helpers of this module travel with the job; executors do not need the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Bytes of paths sent to the tasks at once; a larger ensemble takes several passes over the rows.
SENT = 128_000_000
#: Rows x paths x features worked on at once.
CELLS = 2_000_000


def stored_nodes(spark, model) -> DataFrame:
    """tree, id, left, right (-1 at a leaf), feature, threshold, cover and output of every node.

    The output is a forest's share of class 1, or a boosted tree's prediction, times the tree's weight.
    """
    path = new_path(spark, "trees")
    model.write().save(path)
    forest = "RandomForest" in type(model).__name__
    weights = [float(w) for w in model.treeWeights]
    scale = [w / (sum(weights) if forest else 1.0) for w in weights]
    node = F.col("nodeData")
    stats = node["impurityStats"]
    cover = F.aggregate(stats, F.lit(0.0), lambda a, x: a + x) if forest else stats[0]
    return spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"), node["id"].alias("id"), node["leftChild"].alias("left"), node["rightChild"].alias("right"),
        node["split"]["featureIndex"].alias("feature"), F.get(node["split"]["leftCategoriesOrThreshold"], F.lit(0)).alias("threshold"),
        cover.alias("cover"),
        (F.get(F.array(*map(F.lit, scale)), F.col("treeID")) * (stats[1] / cover if forest else node["prediction"])).alias("output"),
    )


def tree_paths(spark, model, features: int) -> DataFrame:
    """output, and the arrays low, high and share with a place for each feature: one row for each leaf."""
    nodes = materialise(stored_nodes(spark, model), "nodes")
    parent = nodes.where("left >= 0")
    child = nodes.select("tree", F.col("id").alias("child"), F.col("cover").alias("kept"), "output", (F.col("left") < 0).alias("leaf"))
    inf = F.lit(float("inf"))

    def side(column: str, low: Column, high: Column) -> DataFrame:
        rows = parent.select("tree", "id", F.col(column).alias("child"), "feature", low.alias("over"), high.alias("upto"), "cover")
        return rows.join(child, ["tree", "child"])

    steps = side("left", -inf, F.col("threshold")).unionByName(side("right", F.col("threshold"), inf))
    steps = materialise(steps.withColumn("part", F.col("kept") / F.col("cover")).drop("kept", "cover"), "steps")

    def every(value: float) -> Column:
        return F.array_repeat(F.lit(value), features)

    arrays = {"low": every(-float("inf")), "high": every(float("inf")), "share": every(1.0)}
    now = nodes.where("id = 0").select("tree", "id", "output", (F.col("left") < 0).alias("leaf"), *(a.alias(c) for c, a in arrays.items()))
    leaves = [now.where("leaf")]
    merge = {
        "low": lambda x: F.greatest(x, F.col("over")), "high": lambda x: F.least(x, F.col("upto")), "share": lambda x: x * F.col("part"),
    }

    def merged(column: str) -> Column:
        return F.transform(column, lambda x, i: F.when(i == F.col("feature"), merge[column](x)).otherwise(x)).alias(column)

    for _ in range(max(tree.depth for tree in model.trees)):
        inner = now.where("NOT leaf").drop("output", "leaf")
        grown = inner.join(steps, ["tree", "id"]).select(
            "tree", F.col("child").alias("id"), "output", "leaf", *map(merged, merge)
        )
        now = materialise(grown, "level")
        leaves.append(now.where("leaf"))
    out = leaves[0]
    for level in leaves[1:]:
        out = out.unionByName(level)
    return materialise(out.select("output", *arrays), "paths")


def base_value(paths: DataFrame) -> float:
    """The ensemble's output when no feature is known: each leaf by the share of rows that reach it."""
    share = F.aggregate("share", F.lit(1.0), lambda a, x: a * x)
    return float(paths.agg(F.sum(F.col("output") * share)).first()[0])


def by_length(rows: pd.DataFrame) -> list[tuple]:
    """(output, feature, low, high, share) arrays of the paths with equally many features."""
    low, high, share = (np.array(rows[c].tolist(), float) for c in ("low", "high", "share"))
    used = np.isfinite(low) | np.isfinite(high)
    length, groups = used.sum(1), []
    for u in np.unique(length[length > 0]):
        own = length == u
        feature = np.nonzero(used[own])[1].reshape(-1, u)
        take = lambda a: np.take_along_axis(a[own], feature, 1)  # noqa: E731, B023
        groups.append((rows["output"].to_numpy()[own], feature, take(low), take(high), take(share)))
    return groups


def added(x: np.ndarray, total: np.ndarray, group: tuple) -> None:
    """Add the paths' contributions for the rows ``x`` to ``total`` (rows x features)."""
    output, feature, low, high, share = group
    u = feature.shape[1]
    at, weight = np.polynomial.legendre.leggauss((u + 1) // 2)
    at, weight = (at + 1) / 2, weight / 2
    wide = max(1, CELLS // (u * min(len(x), 256)))
    for first in range(0, len(output), wide):
        cut = slice(first, first + wide)
        names = feature[cut].ravel()
        place = np.zeros((len(names), x.shape[1]))
        place[np.arange(len(names)), names] = 1.0
        for top in range(0, len(x), 256):
            some = slice(top, top + 256)
            cells = x[some][:, feature[cut]]
            inside = ((cells > low[cut]) & (cells <= high[cut])).astype(float)
            integral = np.zeros_like(inside)
            for t, w in zip(at, weight):
                factor = share[cut] * (1 - t) + inside * t
                integral += w * factor.prod(2, keepdims=True) / factor
            value = output[cut][:, None] * (inside - share[cut]) * integral
            total[some] += value.reshape(len(value), -1) @ place


def tree_attributions(matrix: DataFrame, features: list[str], model, key: str = K.ID, paths: DataFrame | None = None) -> DataFrame:
    """key, and the arrays values and contributions with a place for each feature; base value + sum = model output."""
    spark = matrix.sparkSession
    paths = tree_paths(spark, model, len(features)) if paths is None else paths
    n = paths.count()
    passes = -(-n * (3 * len(features) + 1) * 8 // SENT) or 1
    rows = matrix.select(key, F.array(*[num(c) for c in features]).alias("values"), F.array_repeat(F.lit(0.0), len(features)).alias("contributions"))
    kind = matrix.schema[key].dataType.simpleString()
    part = F.pmod(F.xxhash64("output", "low", "high"), F.lit(passes))
    for i in range(passes):
        groups = spark.sparkContext.broadcast(by_length(paths.where(part == i).toPandas()))  # SENT bytes on average

        def run(batches: Iterator[pd.DataFrame], groups=groups) -> Iterator[pd.DataFrame]:
            for batch in batches:
                if not len(batch):
                    continue
                x, total = (np.array(batch[c].tolist(), float) for c in ("values", "contributions"))
                for group in groups.value:
                    added(x, total, group)
                yield pd.DataFrame({key: batch[key], "values": batch["values"], "contributions": list(total)})

        rows = rows.mapInPandas(run, f"`{key}` {kind}, values array<double>, contributions array<double>")
        if i + 1 < passes:
            rows = materialise(rows, "attributions")
    return rows


def cells(features: list[str]) -> Column:
    """An array of (feature, value, contribution) from the two arrays."""
    return F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col("values")[i].alias("value"), F.col("contributions")[i].alias("contribution"))
        for i, c in enumerate(features)
    ])


def largest_first(features: list[str]) -> Column:
    """The same, by size of the contribution, then name; no shuffle."""
    ordered = F.sort_array(F.transform(cells(features), lambda c: F.struct((-F.abs(c["contribution"])).alias("size"), c["feature"].alias("feature"), c.alias("cell"))))
    return F.transform(ordered, lambda c: c["cell"])


def top_reasons(attributions: DataFrame, features: list[str], n: int = 3, key: str = K.ID) -> DataFrame:
    """(key, reasons): the n largest contributions of each row."""
    return attributions.select(key, F.slice(largest_first(features), 1, n).alias("reasons"))


def waterfall(attributions: DataFrame, features: list[str], base: float, shown: int = 12) -> DataFrame:
    """Ordered contributions of each row, the ones beyond the ``shown`` - 1 largest as one row; base value + sum = output."""
    ordered = attributions.select(*[c for c in attributions.columns if c not in ("values", "contributions")], largest_first(features).alias("_all"))
    alone = len(features) if len(features) <= shown else shown - 1
    rest = F.aggregate(F.slice("_all", alone + 1, len(features)), F.lit(0.0), lambda a, c: a + c["contribution"])
    other = F.struct(F.lit("other features").alias("feature"), F.lit(None).cast("double").alias("value"), rest.alias("contribution"))
    listed = F.slice("_all", 1, alone)
    if alone < len(features):
        listed = F.concat(listed, F.array(other))
    return ordered.select("*", F.posexplode(listed).alias("place", "cell")).select(
        *[c for c in ordered.columns if c != "_all"], (F.col("place") + 1).alias("place"), "cell.*", F.lit(base).alias("base_value")
    )
