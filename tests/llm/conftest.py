import pytest

LONG = " ".join(f"w{i % 1777}" for i in range(20_000))
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns that the operators use inside, to be carried along or ignored.
CLASHES = ["fp", "spans", "w", "rate", "n_words", "n_tokens", "body", "tested", "_id", "chunk", "hash", "root", "kept", "windows"]


@pytest.fixture(scope="session")
def awkward(spark):
    """Null and empty texts, white space only, a very long one, a repeated row, a repeated id, null ids."""
    plain = "the quick brown fox jumps over the lazy dog and runs far away from here today"
    rows = [
        (1, plain, "en", "a", 10), (2, None, "en", "a", None), (3, "", None, None, 0), (4, " \t\n ", "en", "a", 4),
        (5, LONG, "en", "b", len(LONG)), (6, plain, "de", "b", 10), (6, plain, "de", "b", 10), (None, plain + " x", "fr", None, 1),
        (None, "other words stand here", "fr", "c", None), (7, "one", "en", "a", 3), (7, "two words", "en", "a", 9),
        (8, "\U0001F600 naïve Ünïcode \x1f text", "es", "d", 5),
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def clashing(awkward):
    from pyspark.sql import functions as F

    return awkward.select("*", *(F.lit(f"x{i}").alias(c) for i, c in enumerate(CLASHES)))


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def odd_labels(spark):
    rows = [(1, 1, 0), (1, 1, 0), (2, None, None), (None, 1, 1), (6, 0, 1), (6, 1, 0), (99, 1, 1)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
