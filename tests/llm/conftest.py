import pytest
from pyspark.sql import types as T

LONG = "once upon a midnight dreary while i pondered weak and weary over many a quaint and curious volume of forgotten lore "


@pytest.fixture(scope="session")
def docs_of(spark):
    """documents rows from (doc_id, text), with an extra column whose name clashes with operator outputs."""
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("score", T.StringType())])
    return lambda rows: spark.createDataFrame([(i, t, None) for i, t in rows], schema)


@pytest.fixture(scope="session")
def documents(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


@pytest.fixture(scope="session")
def edge_rows():
    """Nulls, empty and blank texts, ties, repeated rows and a very long text."""
    return [(1, LONG * 6), (2, LONG * 6), (2, LONG * 6), (3, None), (4, ""), (5, " \t\n"), (None, LONG * 6), (None, None), (6, "word " * 60_000), (7, "one two")]
