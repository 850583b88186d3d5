import pytest
from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("text", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("n_words", T.StringType()),  # names that operators use themselves
    T.StructField("_text", T.StringType()),
    T.StructField("token", T.IntegerType()),
    T.StructField("kept", T.IntegerType()),
])


@pytest.fixture(scope="session")
def make_docs(spark):
    """Rows of (id, text) or (id, text, source) with more columns whose names clash."""

    def make(rows):
        filled = [(*row, *(["s"] if len(row) == 2 else []), "w", "t", 3, 4) for row in rows]
        return spark.createDataFrame(filled, DOCS)

    return make


@pytest.fixture(scope="session")
def vocabulary():
    syllables = "ba be bi bo bu da de di do du fa fe fi fo fu ga ge gi go gu".split()
    return [a + b for a in syllables for b in syllables]
