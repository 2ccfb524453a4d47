"""Exact top-k by inner product with multi-resolution segment statistics.

Vectors are whole numbers, floor(256 * x) of each component. A vector is cut into 1, 4 and 16
segments; for each segment its mean and standard deviation are kept. For a segment of length l

    q . x  <=  l * (mean_q * mean_x + deviation_q * deviation_x)

by the inequality of Cauchy and Schwarz, which is the lower bound on the segment's distance
in other words. The sums of these bounds, from coarse to fine, discard pairs that can't reach the
query's k-th best score so far; the exact integer product is computed for the survivors only.

Queries go out in blocks of bounded size, one job for each block, and meet every vector; a task
returns k rows for each query, and a window over those keeps the best. Ties go to the smaller id.

Vectors that are null or hold null or non-finite components take no part. Vectors of different
lengths are never compared. Rows are told apart by a stored number, not by their ids: a query's own
row is no candidate, but another row with its id is, and every query row has k results of its own,
so ids or whole rows that repeat give as many sets of results. A null id is a candidate, placed last
among ties, but no query. Fewer candidates give fewer rows, an empty table gives none. Extra columns
are not read.
"""

import sys
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from lapsewise.sources.workspace import materialise

# executors unpickle the helpers below without having this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SCALE = 256
SEGMENTS = (1, 4, 16)
#: Numbers of all queries in one block: at most 8 MB are broadcast at once.
BLOCK_NUMBERS = 1_000_000
#: Pairs of a query and a vector that a task holds at once.
PAIRS = 2_000_000
#: For rounding in the bounds; scores are whole numbers.
SLACK = 1e-3


def quantised(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """id and whole-number components of the vectors that take part."""
    parts = F.col(embedding)
    real = lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) != float("inf"))
    whole = F.transform(parts, lambda x: F.floor(x.cast("double") * SCALE).cast("double"))
    return vectors.where(parts.isNotNull() & F.forall(parts, real)).select(F.col(vec_id).alias("vec_id"), whole.alias("q"))


def statistics(rows, n: int):
    """Means and deviations of n segments, scaled so that the bound is an inner product."""
    out = []
    for part in np.array_split(rows, n, axis=1):
        if part.shape[1]:
            root = np.sqrt(part.shape[1])
            out += [part.mean(1) * root, part.std(1) * root]
    return np.stack(out, 1)


def levels(rows) -> list:
    return [statistics(rows, n) for n in SEGMENTS if n <= max(rows.shape[1], 1)] if rows.shape[1] else []


class Best:
    """The k best candidates of each query so far."""

    def __init__(self, numbers, ids, rows, k: int):
        self.numbers, self.ids, self.rows, self.k, self.levels = numbers, ids, rows, k, levels(rows)
        self.score = np.full((len(ids), k), -np.inf)
        self.who = np.zeros((len(ids), k), np.int64)
        self.late = np.ones((len(ids), k), bool)  # without an id, or no candidate at all

    def offer(self, numbers, ids, without, rows) -> None:
        """Candidates; ``without`` marks those that have no id."""
        floor = self.score[:, -1]
        alive = self.numbers[:, None] != numbers[None, :]
        for mine, theirs in zip(self.levels, levels(rows)):
            # an equal score can still win by its id
            queries = np.flatnonzero(alive.any(1))
            others = np.flatnonzero(alive.any(0))
            if not len(queries):
                return
            cell = np.ix_(queries, others)
            alive[cell] &= mine[queries] @ theirs[others].T + SLACK >= floor[queries][:, None]
        for i in np.flatnonzero(alive.any(1)):
            own = np.flatnonzero(alive[i])
            score = np.concatenate([self.score[i], rows[own] @ self.rows[i]])
            who = np.concatenate([self.who[i], ids[own]])
            late = np.concatenate([self.late[i], without[own]])
            order = np.lexsort((who, late, -score))[: self.k]
            self.score[i], self.who[i], self.late[i] = score[order], who[order], late[order]

    def table(self):
        found = np.isfinite(self.score)
        number, query = (np.repeat(x, self.k)[found.ravel()] for x in (self.numbers, self.ids))
        return pa.RecordBatch.from_arrays(
            [pa.array(number), pa.array(query), pa.array(self.who[found], mask=self.late[found]), pa.array(self.score[found].astype(np.int64))],
            names=["query_row", "query_id", "vec_id", "score"],
        )


def search(vectors: DataFrame, is_query: Column, k: int = 5, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id and score of each query row's k best candidates; is_query may use vec_id."""
    rows = materialise(quantised(vectors, vec_id, embedding).withColumn("row", F.monotonically_increasing_id()), "vectors")
    queries = materialise(rows.where(is_query & F.col("vec_id").isNotNull()).withColumn("_n", F.size("q")), "queries")
    # blocks of one vector length each, cut by a hash of the row's number
    sizes = queries.groupBy("_n").agg(F.count("*").alias("m")).collect()
    found = [_search_block(rows, queries, size["_n"], part, parts, k)
             for size in sizes for parts in [-(-size["m"] * max(size["_n"], 1) // BLOCK_NUMBERS)] for part in range(parts)]
    if not found:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    best = W.partitionBy("query_row").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last())
    ranked = reduce(DataFrame.union, found).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _search_block(rows: DataFrame, queries: DataFrame, n: int, part: int, parts: int, k: int) -> DataFrame:
    mine = queries.where((F.col("_n") == n) & (F.pmod(F.xxhash64("row"), F.lit(parts)) == part)).select("row", "vec_id", "q").toPandas()
    numbers, ids = (mine[c].to_numpy(np.int64) for c in ("row", "vec_id"))
    block = rows.sparkSession.sparkContext.broadcast((numbers, ids, np.array(mine["q"].tolist(), np.float64).reshape(len(ids), n)))

    def scan(batches):
        best = Best(*block.value, k)
        step = max(16, PAIRS // max(len(block.value[0]), 1))
        for batch in batches:
            for at in range(0, len(batch), step):
                piece = batch.slice(at, step)
                known = piece.column("vec_id")
                ids = np.asarray(known.fill_null(0), np.int64)
                without = np.asarray(known.is_null())
                best.offer(np.asarray(piece.column("row"), np.int64), ids, without, np.asarray(piece.column("q").flatten(), np.float64).reshape(len(piece), n))
        yield best.table()

    # stored, so that the job of each block runs once
    schema = "query_row long, query_id long, vec_id long, score long"
    found = materialise(rows.where(F.size("q") == n).mapInArrow(scan, schema), "nearest")
    block.destroy()
    return found
