import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def make(spark):
    """documents from (doc_id, text) or (doc_id, text, source), with an extra column whose name could clash."""

    def documents(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None if r[1] is None else len(r[1]), 7, "x", 1.0) for r in rows]
        return spark.createDataFrame(full, SCHEMA + ", size long, score string, start double")

    return documents


@pytest.fixture
def odd_rows():
    """Nulls, empty and long texts, repeated rows, equal ids, clashing content."""
    long = "alpha beta gamma delta " * 20_000
    return [(1, None), (2, ""), (3, long), (4, "a b"), (4, "a b"), (4, "other text here"), (None, "no id at all"), (None, None), (5, " \t\n"), (6, "é" * 50)]
