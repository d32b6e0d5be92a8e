import pytest

LONG = " ".join(f"word{i % 977}" for i in range(30_000))
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def edge(spark):
    """Nulls in every column, empty, blank and very long texts, repeated rows and keys."""
    rows = [
        (1, "alpha beta gamma delta epsilon zeta", "en", "a", 35),
        (1, "alpha beta gamma delta epsilon zeta", "en", "a", 35),
        (2, "ALPHA beta gamma delta epsilon zeta", "en", None, 35),
        (3, None, "en", "a", None),
        (4, "", None, "b", 0),
        (5, " \t\n\x0b\x0c\r", "en", "b", 6),
        (6, "one two", "en", "b", 7),
        (7, "one\ntwo", "en", "b", 7),
        (8, LONG, "en", "c", len(LONG)),
        (9, LONG + " tail", "en", "c", None),
        (None, "alpha beta gamma delta epsilon zeta", None, None, None),
        (None, None, None, None, None),
        (10, "12 34 + 56", "en", "a", 10),
        (11, "l1\nl2\nl3\nl4\nx\nl1\nl2\nl3\nl4", "en", "a", 1),
        (12, "l2\nl3\nl4\ny", "en", "a", 1),
        (13, "日本語のテキスト é ñ", "en", "a", 1),
    ]
    return spark.createDataFrame(rows, SCHEMA).repartition(3, "n_chars")


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
