import pytest
from pyspark.sql import types as T

DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # clashing names that the operators use inside
        T.StructField("row", T.StringType()),
        T.StructField("node", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("kept", T.BooleanType()),
    ]
)


@pytest.fixture
def documents(spark):
    """A function texts -> documents with ids 0, 1, ... and columns of clashing names."""

    def make(texts, ids=None, lang="en"):
        ids = range(len(texts)) if ids is None else ids
        rows = [(i, t, lang, "s", None if t is None else len(t), "r", 7, 9, False) for i, t in zip(ids, texts, strict=True)]
        return spark.createDataFrame(rows, DOCUMENTS)

    return make


@pytest.fixture(scope="session")
def odd_texts():
    """Null, empty and blank texts, ties, and one very long text."""
    words = " ".join(f"w{i % 700}x{i}" for i in range(20_000))
    return [None, "", "  \n\t ", "one two three", "one two three", "a\nb\na", "Ünï çödé, Straße's … 你好 é", words]
