import pytest
from pyspark.sql import types as T

from wardline.session import ship_library

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                       T.StructField("n_chars", T.LongType())])


@pytest.fixture
def make_docs(spark):
    """documents from (doc_id, text[, source]) tuples; extra columns clash with the operators' own names."""
    ship_library(spark)

    def make(rows, extra=False):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None if r[1] is None else len(r[1])) for r in rows]
        df = spark.createDataFrame(full, SCHEMA)
        if extra:
            from pyspark.sql import functions as F

            for name in ("id", "key", "bucket", "size", "kept", "place", "score", "host", "content", "piece", "_id"):
                df = df.withColumn(name, F.lit("x"))
        return df

    return make


#: nulls, empty and blank texts, ties, repeated rows, a very long text and one very long word
ODD_ROWS = [(1, None), (2, ""), (3, "  \n\t "), (4, "one two three"), (5, "one two three"), (6, "one two three"),
            (7, "a b c d e f g h " * 4000), (8, "x" * 70_000), (9, "line one\nline two\n\nline one\nline two"),
            (10, "Öß 日本 ’quote sep"), (10, "Öß 日本 ’quote sep"), (None, "no id here"), (None, None),
            (11, "clean text with twenty words " + " ".join(f"w{i}" for i in range(40)))]
