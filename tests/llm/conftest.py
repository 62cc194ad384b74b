import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, row string, words string, size int"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and long texts, repeated rows, and columns whose names clash with the operators'."""
    long_text = "long words make a very long text here. " * 4000
    rows = [
        (1, "One plain sentence stands here.\nAnother line follows it.", "en", "a", 5, "r", "w", 1),
        (2, None, None, None, None, None, None, None),
        (3, "", "en", "a", 0, "r", "w", 1),
        (4, long_text, "en", "a", 9, "r", "w", 1),
        (5, "repeated row", "en", "a", 9, "r", "w", 1),
        (5, "repeated row", "en", "a", 9, "r", "w", 1),
        (5, "same id, other text", "en", "a", 9, "r", "w", 1),
        (None, "no id at all", "en", "a", 9, "r", "w", 1),
        (7, " \n\t ", "fr", "b", 4, "r", "w", 1),
        (8, "été \U0001f600 naïve — 日本語 text with spaces", "fr", "b", 4, "r", "w", 1),
        (9, "x" * 50_000, "fr", "b", 4, "r", "w", 1),
    ]
    return spark.createDataFrame(rows, DOCS)
