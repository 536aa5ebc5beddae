import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table of the given texts, ids from 0."""

    def make(texts, ids=None):
        rows = [(i if ids is None else ids[i], t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
        return spark.createDataFrame(rows, DOCUMENTS)

    return make


@pytest.fixture(scope="session")
def sf_of(spark, tmp_path_factory):
    """A folder of small tables: documents always, others as given."""

    def make(**tables):
        folder = tmp_path_factory.mktemp("sf")
        for name, frame in tables.items():
            frame.coalesce(2).write.parquet(f"{folder}/{name}.parquet")
        return str(folder)

    return make
