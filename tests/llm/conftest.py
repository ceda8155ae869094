import pytest

from tallyroom.llm.tables import ship_package


@pytest.fixture(autouse=True)
def package_on_workers(spark):
    ship_package(spark)


DOCS = "doc_id long, text string, lang string, source string, n_chars long, key string, sig long, h long, row string, ids string"


@pytest.fixture
def make_docs(spark):
    """Documents from (doc_id, text[, lang]) rows, with extra columns whose names the operators use too."""
    def make(rows):
        return spark.createDataFrame([(r[0], r[1], r[2] if len(r) > 2 else "en", "s", len(r[1] or ""), "k", 1, 2, "r", "i")
                                      for r in rows], DOCS)
    return make
