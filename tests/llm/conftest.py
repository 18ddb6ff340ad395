import pytest

TEXT = "the quick brown fox jumps over the lazy dog while seven wise owls watch from an old oak tree near the quiet river bank"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and long texts, ties, repeated rows, and columns named like inner ones."""
    rows = [
        (1, TEXT, "en", "a", "x"), (2, TEXT.upper(), "en", "a", "x"), (3, None, "en", None, "x"), (4, "", None, "b", None), (5, "   \n\t", "en", "b", "x"),
        (6, TEXT + " and then they slept", "en", "a", "x"), (6, TEXT + " and then they slept", "en", "a", "x"), (None, "a text without an id, all alone here", "en", "c", "x"),
        (7, " ".join(f"word{i % 5000}" for i in range(60_000)), "en", "a", "x"), (8, "Ünïcödé ſtraße K \U0001f600 line\nline two", "de", "a", "x"),
    ]
    cols = "doc_id long, text string, lang string, source string, _gone string"
    d = spark.createDataFrame(rows, cols)
    from pyspark.sql import functions as F

    extra = {c: F.lit("clash") for c in ("_id", "_text", "_key", "_keys", "_of", "_src", "_cdf", "copy", "keep_id", "kept", "class_id", "score", "_h", "_norm")}
    return d.withColumns(extra)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
