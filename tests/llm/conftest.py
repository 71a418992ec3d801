import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])


@pytest.fixture(scope="session")
def documents(spark):
    """Builds a documents table from (doc_id, text) or (doc_id, text, source) rows."""
    def build(rows, extra=()):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "a", len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(full, DOCS)
        for name in extra:
            df = df.selectExpr("*", f"'x' as `{name}`")
        return df
    return build
