import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from texts; ids count from 0 unless given."""
    def make(texts, ids=None, langs=None):
        ids = list(range(len(texts))) if ids is None else ids
        langs = langs or ["en"] * len(texts)
        rows = [(i, t, g, "s", len(t) if t is not None else None) for i, t, g in zip(ids, texts, langs)]
        return spark.createDataFrame(rows, DOCS)
    return make
