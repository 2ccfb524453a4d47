"""Null-safe numeric column expressions shared by all operators."""

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def num(value) -> Column:
    """A column as double; names are accepted."""
    return (F.col(value) if isinstance(value, str) else value).cast("double")


def round_even(value: Column, digits: int) -> Column:
    """Round half to even on the scaled double (``F.round`` rounds half up on the text)."""
    scale = F.lit(float(10**digits))
    return F.rint(value.cast("double") * scale) / scale


def clip(value: Column, low: float | None = None, high: float | None = None) -> Column:
    """Limit to [low, high]; null stays null, which bare greatest/least would not keep."""
    out = value
    if low is not None:
        out = F.greatest(out, F.lit(low))
    if high is not None:
        out = F.least(out, F.lit(high))
    return F.when(value.isNotNull(), out)


def nan_to_null(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def ratio(top: Column, bottom: Column) -> Column:
    """Division that gives null on a zero denominator instead of an ANSI error."""
    return F.try_divide(top.cast("double"), bottom.cast("double"))


def ratio_or_zero(top: Column, bottom: Column) -> Column:
    return F.coalesce(ratio(top, bottom), F.lit(0.0))


def right_closed_bin(value: Column, edges: list, labels: list) -> Column:
    """Label of the interval (edges[i], edges[i+1]] holding the value; null outside."""
    chain = F.when(value <= F.lit(edges[0]), F.lit(None))
    for edge, label in zip(edges[1:], labels):
        chain = chain.when(value <= F.lit(edge), F.lit(label))
    return chain


def equal_width_bin(value: Column, low: Column, high: Column, bins: int) -> Column:
    """0-based left-closed histogram bin; the last bin also holds the maximum."""
    width = (high - low) / F.lit(float(bins))
    raw = F.when(width > 0, F.floor((value - low) / width)).otherwise(F.lit(0))
    return F.least(raw, F.lit(bins - 1)).cast("bigint")


def equal_width_cut(value: Column, low: Column, high: Column, bins: int) -> Column:
    """0-based right-closed bin; the first bin also holds the minimum."""
    width = (high - low) / F.lit(float(bins))
    raw = F.when(width > 0, F.ceil((value - low) / width) - 1).otherwise(F.lit(0))
    return F.least(F.greatest(raw, F.lit(0)), F.lit(bins - 1)).cast("bigint")


def count_if(condition: Column) -> Column:
    """Number of rows where the condition holds; 0 (never null) on no rows."""
    return F.count(F.when(condition, F.lit(1)))


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def hash_unit(key: Column, seed: int) -> Column:
    """Uniform [0, 1) number of a key: the first 8 hex digits of md5(key + seed)."""
    digest = F.md5(F.concat(key.cast("string"), F.lit(f"#{seed}")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)
