import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from wordloom.session import local_session  # noqa: E402

DATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark():
    spark = local_session(8)
    yield spark
    spark.stop()


@pytest.fixture(scope="session")
def docs(spark):
    path = f"{DATA}/sf0.001/documents.parquet"
    return spark.read.parquet(path).select("doc_id", "text")


@pytest.fixture()
def corpus(spark):
    """Build a document table from texts, ids from 1."""

    def build(*texts):
        rows = [(i, t) for i, t in enumerate(texts, 1)]
        return spark.createDataFrame(rows, "doc_id long, text string").repartition(3)

    return build
