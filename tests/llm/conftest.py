import pytest
from pyspark.sql import types as T

LONG = "word " * 3000 + "end"


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and long texts, repeated rows, and columns with clashing names."""
    kinds = "doc_id long, text string, row string, hits int, fp long, n_words long, __key string, spans string"
    rows = [
        (1, "An ordinary text. It has two sentences and some more words in it.", "r", 1, 1, 1, "k", "s"),
        (1, "An ordinary text. It has two sentences and some more words in it.", "r", 1, 1, 1, "k", "s"),
        (2, None, None, None, None, None, None, None),
        (None, "no id", "r", 1, 1, 1, "k", "s"),
        (None, None, None, None, None, None, None, None),
        (3, "", "r", 1, 1, 1, "k", "s"),
        (4, LONG, "r", 1, 1, 1, "k", "s"),
        (5, " \n\t ", "r", 1, 1, 1, "k", "s"),
        (6, "é" * 300, "r", 1, 1, 1, "k", "s"),
    ]
    return spark.createDataFrame(rows, kinds).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], T.StructType.fromDDL("doc_id long, text string, n_words long"))
