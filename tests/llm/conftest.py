import pytest
from pyspark.sql import functions as F, types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType())])


@pytest.fixture()
def docs(spark):
    """Makes (doc_id, text, lang, source) and, if asked for, columns whose names the operators use themselves."""
    def make(rows, **clashing):
        full = [tuple(r) + (None,) * (4 - len(r)) for r in rows]
        df = spark.createDataFrame(full, DOCS)
        return df.withColumns({name: F.lit(value) for name, value in clashing.items()})
    return make


@pytest.fixture()
def labels(spark):
    def make(rows):
        return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
    return make
