"""Removal of repeated passages by overlapping windows of three lines, in DataFrame functions only.

A text's lines that hold more than white space, trimmed, form windows of three consecutive lines.
A window that occurs more than once in the whole table stays where it occurs first, by doc_id,
then text hash, then line; at every later place all lines it covers go, with the blank lines
between them. Overlapping windows merge, so a long repeated passage goes as a whole. Every removed
line has an earlier copy that stays. A window is known by two 64-bit hashes.

Texts of fewer than three such lines have no window and stay, null and empty ones among them. A
text that consists of repeated passages becomes empty; no row is dropped. Rows with equal doc_id and
text count as one document and stay equal; a null doc_id comes last. Extra columns pass through, but
for one that has the name of the count of removed lines: the count takes its place.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapsewise.operators.joins import HOT_ROWS
from lapsewise.sources.workspace import materialise

LINES = 3
SPACE_CHARS = " \t\n\x0b\x0c\r"


def windows(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, the text's hash, two hashes of each window, and its first and last line."""
    trimmed = F.transform(
        F.split(F.col(text), "\n"), lambda x, i: F.struct(i.alias("i"), F.btrim(x, F.lit(SPACE_CHARS)).alias("line"))
    )
    lines = F.transform(
        F.filter(trimmed, lambda x: x["line"] != ""),
        lambda x: F.struct(x["i"].alias("i"), F.xxhash64(x["line"]).alias("a"), F.xxhash64(F.lit(1), x["line"]).alias("b")),
    )
    rows = docs.select("doc_id", F.xxhash64(text).alias("_text"), lines.alias("_lines"))
    own = F.col("_lines")

    def window(x, k):
        ahead = [F.get(own, k + n) for n in range(1, LINES)]
        return F.struct(
            F.xxhash64(x["a"], *(y["a"] for y in ahead)).alias("a"), F.xxhash64(x["b"], *(y["b"] for y in ahead)).alias("b"),
            x["i"].alias("first"), ahead[-1]["i"].alias("last"),
        )

    n = F.size(own)
    found = F.transform(F.slice(own, F.lit(1), F.greatest(n - (LINES - 1), F.lit(0))), window)
    return rows.where(n >= LINES).select("doc_id", "_text", F.inline(found))


def repeated(found: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """The places of windows that occur earlier as well.

    The places of a window that occurs more than ``hot_rows`` times are spread over several tasks. There
    are at most places / hot_rows such windows, so their list is broadcast.
    """
    at = F.struct(F.col("doc_id").isNull(), "doc_id", "_text", "first")
    parts = F.ceil(F.col("_n") / F.lit(float(hot_rows))).cast("bigint")
    first = found.groupBy("a", "b").agg(F.min(at).alias("_at"), F.max(at).alias("_end"), F.count("*").alias("_n"))
    first = materialise(first.where("_at < _end").drop("_end"), "first_places")
    hot = first.where(F.col("_n") > hot_rows).select("a", "b", parts.alias("_parts"))
    salt = F.coalesce(F.pmod(F.xxhash64("doc_id", "_text", "first"), F.col("_parts")), F.lit(0).cast("bigint"))
    dealt = found.join(F.broadcast(hot), ["a", "b"], "left").withColumn("_salt", salt)
    known = first.select("a", "b", "_at", F.explode(F.sequence(F.lit(0).cast("bigint"), parts - 1)).alias("_salt"))
    return dealt.join(known, ["a", "b", "_salt"]).where(at > F.col("_at")).select("doc_id", "_text", "first", "last")


def without_repeats(docs: DataFrame, text: str = "text", removed: str = "n_removed", hot_rows: int = HOT_ROWS) -> DataFrame:
    """The rows with shortened texts, and a last column ``removed``: how many lines went."""
    found = materialise(windows(docs, text), "windows")
    gone = repeated(found, hot_rows).groupBy("doc_id", "_text").agg(
        F.array_distinct(F.flatten(F.collect_set(F.sequence("first", "last")))).alias("_gone")
    ).withColumnRenamed("doc_id", "_id")
    # the row travels as one struct, so that its columns' names don't matter
    rows = docs.select("doc_id", F.xxhash64(text).alias("_own"), F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"))
    both = rows.join(gone, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_own") == F.col("_text")), "left")
    full = F.col(f"_row.`{text}`")
    both = both.select("_row", "_gone", F.when(F.col("_gone").isNotNull(), F.split(full, "\n")).alias("_lines"))
    kept = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("_gone"))
    short = F.array_join(F.transform(kept, lambda i: F.get(F.col("_lines"), i)), "\n")
    shortened = F.when(F.col("_gone").isNull(), full).otherwise(short)
    out = [shortened.alias(c) if c == text else F.col(f"_row.`{c}`") for c in docs.columns if c.lower() != removed.lower()]
    return both.select(*out, F.greatest(F.size("_gone"), F.lit(0)).cast("long").alias(removed))
