import pytest

LONG = " ".join(f"word{k % 977}" for k in range(60_000)) + " " + "x" * 50_000


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Null, empty, blank, repeated, tied and very long texts, a null and a repeated id, and columns with names that operators use."""
    rows = [
        (1, "alpha beta gamma delta epsilon zeta eta theta", "en", "a", 1.5, True),
        (2, None, "en", "a", None, None),
        (3, "", None, None, 0.0, False),
        (4, " \t\n ", "de", "b", 0.0, False),
        (5, LONG, "en", "b", 0.0, False),
        (6, LONG, "en", "b", 0.0, False),
        (1, "alpha beta gamma delta epsilon zeta eta theta", "en", "a", 1.5, True),
        (1, "another text under the same id", "fr", "a", 1.5, True),
        (None, "a text without an id", "en", "a", 1.5, True),
        (7, "12345 !!! ???", "en", "a", 1.5, True),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, score double, keep boolean").withColumnsRenamed({}).selectExpr(
        "*", "1 AS mark", "2 AS fp", "'y' AS predicted", "3 AS mix_rate", "4L AS n_chars", "5 AS component_id", "6 AS n_words"
    )


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("false")
