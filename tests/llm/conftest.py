import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(60_000))
SHORT = "The quick brown fox jumps over the lazy dog"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, and columns with clashing names."""
    rows = [(1, SHORT, "en", "a"), (1, SHORT, "en", "a"), (2, SHORT + " ", "en", "b"), (3, "", "de", "a"), (4, None, None, None),
            (None, SHORT, "en", None), (None, None, None, None), (5, " \t\r\n\x0b\x0c", "en", "b"), (6, LONG, "fr", "a"),
            (7, LONG, "fr", "a"), (8, "x", "en", "a"), (9, "é x \U0001f600", "es", ""), (9, "another text", "es", ""),
            (10, " ".join(["again and"] * 200), "en", "a")]
    docs = spark.createDataFrame([(*r, None if r[1] is None else len(r[1])) for r in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    names = ("row", "th", "_d", "_t", "_kept", "size", "score", "_score", "chunk", "part", "records", "fp", "key", "name", "block",
             "rank", "kept", "made", "_words", "at", "n", "toxic")
    return docs.withColumns({c: F.lit(c) for c in names})


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("false")


@pytest.fixture(scope="session")
def few_docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")
