import pytest
from pyspark.sql import functions as F, types as T

EDGE_TEXTS = [None, "", " \t\n", "a", "one two three", "One TWO three", "one two three", "x " * 3000, "élève naïve 中文 \U0001f600", "line one here\nline two here\n\nline three here", "<|endoftext|> 's don't"]


@pytest.fixture
def edge_docs(spark):
    """Nulls in every column, empty and long texts, repeated rows, and extra columns with names that operators use inside."""
    schema = "doc_id long, text string, id string, key double, label string, block string, n int, family int, ids array<int>"
    rows = [(i, t, None if i % 2 else "x", None, "l", None, i, None, None) for i, t in enumerate(EDGE_TEXTS)]
    return spark.createDataFrame([*rows, rows[4], (None, "one two three", *rows[0][2:]), (None, None, *rows[0][2:])], schema)


@pytest.fixture
def empty_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, id string")


def words_of(text):
    import re

    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return re.findall(r"[^\x20\x09-\x0d]+", (text or "").translate(low))


@pytest.fixture(scope="session")
def documents(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    return {r.doc_id: r.text for r in documents.collect()}
