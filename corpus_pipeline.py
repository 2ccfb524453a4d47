"""The corpus pipeline: documents in, packed training sequences out.

Each stage takes what the one before kept and returns the columns of documents, the last one the
packed pieces. A stage's rows are written before the next one reads them. The columns of a document
travel as one struct next to what an operator needs, so extra columns of any name pass through.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapsewise.llm import knn_quality, line_dedup, minhash, packing, weak_rules
from lapsewise.llm.queries import TOKENIZER
from lapsewise.sources.workspace import materialise

#: Score from which the classifier's documents stay.
MIN_SCORE = 0.3
#: Words of a shingle of near duplicates (query op3 takes four by its contract).
NEAR_WORDS = 5


def boxed(docs: DataFrame) -> DataFrame:
    """doc_id, text, and the whole row as a struct."""
    return docs.select("doc_id", "text", F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weakly supervised rules keep."""
    return weak_rules.judged(boxed(docs)).where("_rules.kept").select("row.*")


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the corpus's labelled documents, finds good enough."""
    corpus = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = knn_quality.fit(corpus, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return docs.where(knn_quality.score(docs, model) >= MIN_SCORE)


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without passages that stand earlier in the corpus; n_chars follows the text."""
    rows = line_dedup.without_repeats(boxed(docs))
    changed = {"text": F.col("text")} | ({"n_chars": F.length("text").cast("long")} if "n_chars" in docs.columns else {})
    names = docs.columns
    return rows.select(*(
        F.when(F.col("n_removed") > 0, changed[c]).otherwise(F.col(f"row.`{c}`")).alias(c) if c in changed else F.col(f"row.`{c}`")
        for c in names
    ))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates: the one with the smallest doc_id, null last.

    Rows are linked by numbers of their own, so that rows without doc_id, or with one doc_id and several texts, are
    linked by what they say; a row linked with nothing stays.
    """
    rows = materialise(boxed(docs).select(F.monotonically_increasing_id().alias("_row"), "row"), "numbered")
    found = minhash.near_duplicates(rows.select(F.col("_row").alias("doc_id"), "row.text"), NEAR_WORDS)
    found = materialise(found.select("doc_id", "component_id"), "found")
    several = found.groupBy("component_id").agg(F.count("*").alias("n")).where("n > 1")
    several = materialise(found.join(several, "component_id").select(F.col("doc_id").alias("_row"), "component_id"), "several")
    members = several.join(rows.select("_row", F.col("row.doc_id").alias("id")), "_row")
    first = members.groupBy("component_id").agg(F.min(F.struct(F.col("id").isNull(), "id", "_row"))["_row"].alias("_row"))
    gone = several.select("_row").join(first.select("_row"), "_row", "left_anti")
    return rows.join(gone, "_row", "left_anti").select("row.*")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces in sequences of 4096 ids."""
    return packing.pack_documents(docs, TOKENIZER)


STAGES = [
    ("quality_rules", quality_rules),
    ("quality_classifier", quality_classifier),
    ("line_dedup", repeated_lines),
    ("near_dedup", near_duplicates),
    ("packing", packed),
]

#: Learned accuracies, neighbours and components are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return docs
