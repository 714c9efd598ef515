import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """documents(rows) -> DataFrame of (doc_id, text) with the other columns of the table, and one more."""
    def make(rows, lang="en"):
        data = [(i, t, lang, "s", None if t is None else len(t), f"x{k}") for k, (i, t) in enumerate(rows)]
        return spark.createDataFrame(data, DOCS + ", extra string")
    return make


@pytest.fixture
def table(spark):
    """table(name) -> a given table of the smallest size, or skip."""
    import os

    def make(name, sf="/root/testdata/sf0.001"):
        if not os.path.isdir(sf):
            pytest.skip("test tables are not here")
        return spark.read.parquet(f"{sf}/{name}.parquet")
    return make
