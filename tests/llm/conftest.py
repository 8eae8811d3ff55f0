import pytest


@pytest.fixture(scope="session")
def docs_of(spark):
    """documents from (doc_id, text, source) tuples, with a clashing extra column."""

    def build(rows):
        full = [(i, t, "en", s, len(t or ""), "x") for i, t, s in rows]
        return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long, score string")

    return build
