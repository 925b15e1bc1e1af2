import pytest


@pytest.fixture(scope="session")
def documents(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make_documents(spark):
    def make(rows):
        full = [(i, t, None, None, None if t is None else len(t)) for i, t in rows]
        return spark.createDataFrame(full, DOCUMENTS)

    return make
