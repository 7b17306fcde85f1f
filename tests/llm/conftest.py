import pytest
from pyspark.sql import types as T

# Columns of documents, plus ones whose names the operators use inside.
DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
                     T.StructField("score", T.StringType()), T.StructField("block", T.StringType()), T.StructField("n", T.StringType())])


@pytest.fixture
def docs(spark):
    """(id, text[, source]) tuples as a documents table."""
    def make(rows):
        full = [(r[0], r[1], None, r[2] if len(r) > 2 else "s", None, "x", None, "y") for r in rows]
        return spark.createDataFrame(full, DOCS)
    return make
