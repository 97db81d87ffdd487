import pytest

DOCS = "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG"


@pytest.fixture
def docs_of(spark):
    """(id, text) pairs as a table with the columns of documents."""
    def make(rows, langs=None):
        langs = langs or {}
        return spark.createDataFrame([(i, t, langs.get(i, "en"), "src", len(t or "")) for i, t in rows], DOCS)
    return make


@pytest.fixture
def clashing():
    """Adds columns whose names operators may use inside."""
    from pyspark.sql import functions as F

    def add(df):
        for name in ("keep_id", "length", "hash", "digest", "n", "u", "v", "key", "cls", "ids", "score", "line", "h",
                     "positions", "shingles", "label", "part", "group_size", "node", "component", "_salt"):
            df = df.withColumn(name, F.lit("x"))
        return df
    return add
