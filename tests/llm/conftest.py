import pytest

from ledgerflow.llm.common import send_package

DOCS = "doc_id long, text string, lang string, source string, n_chars long, row string, t string, _doc string, seed string"


@pytest.fixture(autouse=True)
def _package(spark):
    send_package(spark)


@pytest.fixture
def docs_of(spark):
    """Documents from (doc_id, text, lang, source); the other columns bear names that operators use inside."""

    def make(rows):
        return spark.createDataFrame([(i, t, la, s, len(t or ""), "r", "t", "d", "s") for i, t, la, s in rows], DOCS)

    return make


#: Null and empty texts, null ids, ties and repeated rows.
ODD = [(1, "The cat sat on the mat. It was warm!", "en", "a"), (1, "The cat sat on the mat. It was warm!", "en", "a"), (2, None, "en", None),
       (3, "", None, "b"), (None, "the cat sat on the mat. it was warm!", "en", "b"), (4, " \t\n\r ", "en", "a"), (5, "12 34 !!", "de", "c"),
       (6, "word " * 30_000, "en", "c"), (7, "Der Hund schläft über Nacht im Garten", "de", "a"), (7, "anderer Text gleiche Nummer", "de", "a")]
