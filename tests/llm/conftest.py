import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(__file__))


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]


@pytest.fixture()
def odd_documents(spark):
    """Null ids and texts, empty, repeated and long texts, and extra columns with names used inside."""
    rows = [
        (None, "a b c d e", 1, "x"), (None, None, 2, "x"), (1, "", 3, None), (2, None, 4, "x"), (3, "a b c", 5, "x"),
        (4, "A  b\tc", 6, "x"), (5, "zz yy", 7, "x"), (5, "zz yy", 7, "x"), (6, "x " * 30000, 0, "x"),
        (7, "one\n\ntwo\n three\nfour", 1, "x"), (8, "four\none\ntwo\nthree \nfour", 1, "x"),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, node int, _text string")


@pytest.fixture()
def no_documents(spark):
    return spark.createDataFrame([], "doc_id long, text string")
