import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
LONG = " ".join(f"word{i % 700}" for i in range(30_000))
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows,
    and extra columns whose names clash with those the operators use."""
    rows = [
        (1, None, None, None, None), (2, "", "en", "a", 0), (3, " \t\n", "en", "a", 3), (4, LONG, "en", "a", len(LONG)),
        (5, LONG, "en", "b", len(LONG)), (5, LONG, "en", "b", len(LONG)), (6, "one two", "en", None, 7),
        (None, "one two", "en", "b", 7), (7, "x@y.org and 10.0.0.1 \U0001F642 é", "fr", "b", 26), (7, "another text of this id", "fr", "b", 23),
        (None, None, None, None, None),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    clash = ("id", "size", "target", "copies", "chunk", "tie", "fp", "words", "kept", "ids", "score", "fold", "part", "toxic")
    return df.select("*", *[F.lit(f"own {c}").alias(c) for c in clash])


@pytest.fixture(scope="session")
def empty(odd):
    return odd.limit(0)
