import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from brute import EDGES, SCHEMA  # noqa: E402


@pytest.fixture(scope="session")
def edges(spark):
    rows = [(i, t, "en", "s", 0, "n", 1, 2, "l", 0.5, 1, 7, 3, "k", 1) for i, t in EDGES]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    return [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
