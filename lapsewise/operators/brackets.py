"""Exact quantiles without sorting or shuffling the values.

Each wanted rank of a column is enclosed between two cut points from a mergeable sketch. One pass then counts
the rows before, at and after every cut. A rank that falls on a cut is found; one between two cuts is
enclosed more tightly by a sketch of just the rows there, until few values are left, and these are collected.
Counts are exact, so a sketch that misses only costs another round. Every round takes at least one value out
of the open rows, so values with very many copies end as a cut.

A task sends one sketch or count for each column and interval, whatever the number of its rows. ``by``
columns are for few groups: the driver holds groups x columns x fractions intervals.
"""

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lapsewise.operators.ranks import unpivot_numeric
from lapsewise.sources.workspace import materialise

#: Open values of one rank that are collected.
FEW = 4096
#: Error of a sketch is one part in ACCURACY of its rows; GRID + 1 of its quantiles come to the driver.
ACCURACY, GRID = 2000, 400


def _order(value: float) -> tuple:
    """NaN comes last, as in Spark."""
    return (True, 0.0) if math.isnan(value) else (False, value)


class Ranks:
    """Search for some ranks (from 0) of one column of one group."""

    def __init__(self):
        self.total, self.cuts, self.counts, self.found = 0, [], {}, {}
        self.open: set[int] = set()

    def start(self, total: int, fractions: list[float]) -> None:
        self.total, self.counts = total, {0: total}
        for q in fractions:
            self.open |= {math.floor((total - 1) * float(q)), math.ceil((total - 1) * float(q))}

    def place(self, rank: int) -> tuple[int, int]:
        """The interval that holds a rank, and the rank inside it; odd intervals are cuts."""
        for slot in sorted(self.counts):
            if rank < self.counts[slot]:
                return slot, rank
            rank -= self.counts[slot]
        raise AssertionError("a rank beyond the rows")

    def settle(self) -> None:
        for rank in sorted(self.open):
            slot, _ = self.place(rank)
            if slot % 2:
                self.found[rank] = self.cuts[slot // 2]
                self.open.discard(rank)

    def wanted(self, few: int, small: bool) -> list[int]:
        slots = {self.place(rank)[0] for rank in self.open}
        return sorted(s for s in slots if (self.counts[s] <= few) == small)

    def cut(self, slot: int, low: float, high: float, grid: list[float] | None) -> list[float]:
        """Cuts around each open rank of an interval, from its sketch."""
        cuts = []
        for rank in self.open:
            at, inside = self.place(rank)
            if at == slot:
                share, margin = (inside + 0.5) / self.counts[slot], 1.5 / ACCURACY
                below, above = math.floor((share - margin) * GRID), math.ceil((share + margin) * GRID)
                cuts.append(grid[below] if grid and below >= 0 else low)
                cuts.append(grid[above] if grid and above <= GRID else high)
        return cuts

    def add(self, cuts: list[float]) -> None:
        known = {_order(c) for c in self.cuts}
        fresh = {_order(c): c for c in cuts if _order(c) not in known}
        self.cuts = sorted([*self.cuts, *fresh.values()], key=_order)

    def collected(self, slot: int, values: list[float]) -> None:
        values = sorted(values, key=_order)
        for rank in sorted(self.open):
            at, inside = self.place(rank)
            if at == slot:
                self.found[rank] = values[inside]

    def quantile(self, q: float) -> float:
        at = (self.total - 1) * float(q)
        low, high = self.found[math.floor(at)], self.found[math.ceil(at)]
        return low + (at - math.floor(at)) * (high - low)


def find_quantiles(df: DataFrame, columns: list[str], fractions: list[float], by: list[str] = (), few: int = FEW) -> dict:
    """{(group values..., column): {fraction: value}}, linear interpolation; nulls and empty columns are left out.

    The needed columns are stored once and scanned about three times; a table of very many rows takes two
    scans more for each factor of about 200 in rows.
    """
    spark, keys = df.sparkSession, [*by, "feature"]
    stored = materialise(df.select(*by, *[F.col(c).cast("double").alias(c) for c in columns]), "columns")
    # adding 0.0 makes one zero of the two
    values = unpivot_numeric(stored, columns, list(by)).withColumn("value", F.col("value") + F.lit(0.0))
    schema = T.StructType([T.StructField(f"_{k}", values.schema[k].dataType) for k in keys]).add("cuts", T.ArrayType(T.DoubleType())).add("wanted", T.ArrayType(T.IntegerType()))

    def slots(wanted: dict | None = None) -> DataFrame:
        """Values of searched columns with their interval; only of the wanted intervals, if given."""
        rows = [(*key, state.cuts, (wanted or {}).get(key)) for key, state in states.items() if state.open and (wanted is None or wanted[key])]
        known = spark.createDataFrame(rows, schema)
        same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
        before = F.size(F.filter("cuts", lambda c: c < F.col("value"))) + F.size(F.filter("cuts", lambda c: c <= F.col("value")))
        # Spark doesn't know how small the list is, and its few keys would gather all values in as many tasks
        placed = values.join(F.broadcast(known), same).withColumn("slot", before)
        return placed if wanted is None else placed.where(F.array_contains("wanted", F.col("slot")))

    def sketch(rows: DataFrame) -> list:
        grid = F.percentile_approx(F.when(~F.isnan("value"), F.col("value")), [i / GRID for i in range(GRID + 1)], ACCURACY)
        return rows.groupBy(*keys, "slot").agg(
            F.count(F.lit(1)).alias("n"), F.min("value").alias("low"), F.max("value").alias("high"), grid.alias("grid")
        ).collect()

    def key_of(row) -> tuple:
        return tuple(row[k] for k in keys)

    states: dict[tuple, Ranks] = {}
    sketches = sketch(values.withColumn("slot", F.lit(0)))
    for row in sketches:
        states[key_of(row)] = Ranks()
        states[key_of(row)].start(row["n"], fractions)
    while True:
        large = {key: state.wanted(few, small=False) for key, state in states.items()}
        if not any(large.values()):
            break
        if sketches is None:
            sketches = sketch(slots(large))
        fresh: dict[tuple, list] = {}
        for row in sketches:
            if row["slot"] in large[key_of(row)]:
                fresh.setdefault(key_of(row), []).extend(states[key_of(row)].cut(row["slot"], row["low"], row["high"], row["grid"]))
        for key, cuts in fresh.items():
            states[key].add(cuts)
            states[key].counts = {}
        for row in slots().groupBy(*keys, "slot").count().collect():
            states[key_of(row)].counts[row["slot"]] = row["count"]
        for state in states.values():
            state.settle()
        sketches = None
    small = {key: state.wanted(few, small=True) for key, state in states.items()}
    if any(small.values()):
        for row in slots(small).groupBy(*keys, "slot").agg(F.collect_list("value").alias("values")).collect():
            states[key_of(row)].collected(row["slot"], row["values"])
    return {key: {q: state.quantile(q) for q in fractions} for key, state in states.items()}


def collect_quantiles(df: DataFrame, columns: list[str], fractions: list[float]) -> dict:
    """{column: {fraction: value}}; an empty column has no values."""
    found = find_quantiles(df, columns, fractions)
    return {c: found.get((c,), {}) for c in columns}


def quantile_rows(df: DataFrame, columns: list[str], fractions: list[float], by: list[str] = ()) -> DataFrame:
    """(by..., feature, fraction, quantile) for few groups."""
    schema = T.StructType([df.schema[c] for c in by]).add("feature", "string").add("fraction", "double").add("quantile", "double")
    found = find_quantiles(df, columns, fractions, by)
    return df.sparkSession.createDataFrame([(*key, float(q), value) for key, at in found.items() for q, value in at.items()], schema)
