import pytest
from pyspark.sql import types as T

# Column names that the operators use inside; inputs may have them too.
CLASHING = ["id", "key", "n", "sig", "token", "host", "path", "hash", "size", "bucket", "low", "same", "start", "th", "slot", "range",
            "spans", "lines", "verdict", "component", "__id", "__text", "words", "block", "at", "file", "weight", "target", "copies", "__gone", "__content", "__drop", "wanted", "y"]

LONG = " ".join(f"w{k}" for k in range(30_000))
BASE = " ".join(f"tok{k}" for k in range(60))

ROWS = [
    (0, BASE, "en", "a"),
    (1, BASE, "en", "a"),                       # an exact copy
    (2, BASE.replace("tok59", "tok60"), "en", None),  # a near copy on a null source
    (3, None, None, "a"),
    (4, "", "en", "b"),
    (5, " \n\t ", "en", "b"),
    (6, "one", "en", "b"),
    (7, LONG, "de", "b"),
    (7, LONG, "de", "b"),                       # a repeated row
    (None, "a row without an id " * 12, "de", "b"),
    (9, "x y x y x y x y " * 40, "de", "c"),
    (10, "Grüße an alle\nGrüße an alle\n###", None, "c"),
]


def documents(spark, rows=ROWS):
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                           T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()), *(T.StructField(c, T.StringType()) for c in CLASHING)])
    return spark.createDataFrame([(i, t, lang, s, len(t or ""), *["?"] * len(CLASHING)) for i, t, lang, s in rows], schema)


@pytest.fixture(scope="session")
def docs(spark):
    return documents(spark).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return documents(spark, [])
