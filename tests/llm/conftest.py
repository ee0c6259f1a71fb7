import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Rows (doc_id, text, source, extra values ...) as documents; ``extra`` names more columns."""
    def make(rows, extra=""):
        return spark.createDataFrame([(i, t, "en", s, None if t is None else len(t)) + tuple(r)
                                      for i, t, s, *r in rows], SCHEMA + extra)
    return make
