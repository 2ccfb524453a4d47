"""Licence scans by canonical digests.

A text is made canonical: copyright lines go, letters become lower case, everything that is neither
a letter nor a digit separates words, and equivalent spellings become one. The SHA-256 of the whole
canonical text is hash-joined to the digests of the known licences. Each line of a text is looked up
in the same way as a text of its own, so declarations of one line are found as well.

A null text counts as empty; an empty canonical text is no licence. Only candidates whose canonical
length and first letters are those of a known licence need a digest for the join, which excludes nothing. Repeated rows
get equal results, extra columns are ignored, an empty table gives an empty one.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lapsewise.llm.license_texts import DECLARATIONS, SPELLINGS, TEXTS
from lapsewise.sources.workspace import materialise

#: A line that begins with a copyright sign or word, or only reserves all rights.
COPYRIGHT = r"^[^\p{L}\p{N}]*(?:copyright\b.*|\(c\).*|©.*|all rights reserved\W*)$"

#: Letters compared before a digest is computed.
START = 12


def known(spark: SparkSession, texts: dict[str, str] = TEXTS, declarations: dict[str, str] = DECLARATIONS) -> DataFrame:
    """license_id, size, first letters and digest of each known text, made canonical like any other."""
    rows = [(name, text) for name, text in texts.items()] + [(name, line) for line, name in declarations.items()]
    forms = spark.createDataFrame(rows, "license_id string, text string").withColumn("whole", F.array_join(canonical_lines(F.col("text")), " "))
    start = F.substring("whole", 1, START)
    return forms.where("whole <> ''").select("license_id", F.length("whole").alias("size"), start.alias("start"), F.sha2("whole", 256).alias("digest")).distinct()


def canonical_lines(text: Column) -> Column:
    """The canonical form of each line."""
    spelling = F.create_map(*(F.lit(x) for pair in SPELLINGS.items() for x in pair))

    def form(line: Column) -> Column:
        words = F.split(F.trim(F.regexp_replace(line, r"[^\p{L}\p{N}]+", " ")), " ")
        return F.array_join(F.transform(words, lambda w: F.coalesce(F.element_at(spelling, w), w)), " ")

    lines = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), "\n"), lambda x: ~x.rlike(COPYRIGHT))
    return F.filter(F.transform(lines, form), lambda x: x != "")


def scanned(docs: DataFrame, licenses: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, the digest of the canonical text, the whole text's license_id, and the ids found in single lines."""
    licenses = materialise(licenses.coalesce(1), "licenses")
    sizes, starts = ([row[c] for row in licenses.select(c).distinct().collect()] for c in ("size", "start"))
    rows = docs.select("doc_id", canonical_lines(F.col(text)).alias("_lines"))
    lines = F.array_distinct(F.filter("_lines", lambda x: F.length(x).isin(sizes) & F.substring(x, 1, START).isin(starts)))
    rows = rows.select(
        "doc_id", F.monotonically_increasing_id().alias("_row"), F.sha2(F.array_join("_lines", " "), 256).alias("digest"),
        F.transform(lines, lambda x: F.sha2(x, 256)).alias("_digests"),
    )
    rows = materialise(rows, "digests")
    lookup = licenses.select("license_id", F.col("digest").alias("_known"))
    lines = rows.select("_row", F.explode("_digests").alias("_digest")).join(lookup, F.col("_digest") == F.col("_known"))
    lines = lines.groupBy("_row").agg(F.array_sort(F.collect_set("license_id")).alias("_ids"))
    whole = rows.join(lookup, F.col("digest") == F.col("_known"), "left").join(lines, "_row", "left")
    return whole.select("doc_id", "digest", "license_id", F.coalesce(F.array_join("_ids", " "), F.lit("")).alias("line_licenses"))
