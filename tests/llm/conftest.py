import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score int, spans string"


@pytest.fixture
def odd_docs(spark):
    """Nulls in every column, empty and long texts, repeated rows, and columns whose names clash with results."""
    rows = [(1, None, None, None, None, 1, "x"), (2, "", "en", "s", 0, None, None), (3, " \n\t ", "en", "s", 4, 1, "x"), (None, "the cat sat on the mat", "en", None, 22, 1, "x"),
            (4, "the cat sat on the mat. " * 5000, "en", "s", 120000, 1, "x"), (5, "eine Katze saß auf der Matte und schlief", "de", "s", 40, 1, "x"),
            (5, "eine Katze saß auf der Matte und schlief", "de", "s", 40, 1, "x"), (6, "1234 5678 !!", "en", "s", 12, 1, "x")]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
