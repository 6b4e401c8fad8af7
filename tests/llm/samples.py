"""Sample documents for the tests of the text operators."""

from pyspark.sql import types as T

SF = "/root/testdata/sf0.001"
#: Documents of a real shape, with columns whose names operators use inside.
SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    *(T.StructField(c, T.StringType()) for c in ("body", "k", "k_id", "k_sha", "n", "h", "size", "shard", "bin", "tail", "words", "score", "m", "y"))])


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "en", *["x"] * 14) for i, t in rows], SCHEMA)


LONG = " ".join(f"word{i * 7919 % 4001}" for i in range(12_000))
#: Nulls, empties, blanks, repeated rows, ties, a null id and a very long text.
MESSY = [(1, "the same text here"), (2, "the same text here"), (2, "the same text here"), (3, None), (4, ""), (5, "  \n "), (6, "x"),
         (None, "a text without an id"), (8, LONG), (9, LONG), (10, LONG[:5000] + " other end"), (11, "Ünïcode ▁ text 漢字"), (12, "x")]
