import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                       T.StructField("n_chars", T.LongType())])


def make(spark, rows, extra=()):
    """Documents from ``(doc_id, text, source)``, with extra string columns of the given names."""
    schema = T.StructType([*SCHEMA, *[T.StructField(c, T.StringType()) for c in extra]])
    data = [(i, t, "en", s, len(t or ""), *["x" for _ in extra]) for i, t, s in rows]
    return spark.createDataFrame(data, schema)


LONG = " ".join(f"w{k % 997}x{k % 13}" for k in range(30_000))
#: Nulls, empty and very long texts, ties, repeated rows, no id, no source.
ODD = [
    (1, None, "a"), (2, "", "a"), (3, " \t\r\n\x0b\x0c ", "b"), (4, "one two", None), (5, LONG, "hot"), (6, LONG, "hot"),
    (7, "one  two", "b"), (8, "éé ñ one two three", "hot"), (8, "éé ñ one two three", "hot"), (None, "one two", "hot"),
    (9, "one two three four one two three five " * 20, "hot"), (10, "same line\nsame line\n\nsame line", "a"),
    (11, "   \u0085x \U0001f600 y", "a"), (12, "ONE Two", "b"), (None, None, None),
]
CLASH = ("row", "kept", "keep_id", "place", "tokens", "digest", "salt", "host", "copies", "print", "of", "content",
         "short", "length", "ids", "sha", "ticket", "of_", "epochs")


@pytest.fixture(scope="session")
def odd(spark):
    return make(spark, ODD).cache()


@pytest.fixture(scope="session")
def clashing(spark):
    return make(spark, ODD, CLASH).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return make(spark, [], CLASH)
