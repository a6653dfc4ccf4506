import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                       T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
                       # names that operators use inside
                       T.StructField("id", T.StringType()), T.StructField("n", T.StringType()), T.StructField("key", T.StringType())])


@pytest.fixture(scope="session")
def make(spark):
    def build(rows):
        return spark.createDataFrame([(i, t, lang, "s", None if t is None else len(t), "x", "y", "z") for i, t, lang in rows], SCHEMA)
    return build


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in any column, empty and blank texts, ties, repeated rows and one very long text."""
    long = " ".join(f"w{i % 977}x{i % 31}" for i in range(60_000))
    return [(1, None, "en"), (2, "", None), (3, " \n\t ", "en"), (4, "one", "en"), (5, "one two", "fr"), (5, "one two", "fr"),
            (6, "One TWO", None), (7, long, "en"), (8, long, "de"), (None, "a null id", "en"), (9, "12 34 !!", "en")]
