"""Small tables that every corpus operator must accept."""

from pyspark.sql import types as T

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType()),
                     # names that operators use themselves
                     T.StructField("score", T.StringType()), T.StructField("h", T.StringType()),
                     T.StructField("length", T.StringType()), T.StructField("fp", T.StringType())])


def docs_of(spark, rows):
    """documents from (doc_id, text) pairs, with extra columns of clashing names."""
    return spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t), "x", None, "y", "z") for i, t in rows], DOCS)


LONG = " ".join(f"word{i % 977} x{i % 31}" for i in range(30000))
EDGE = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "one two"), (5, "one two"), (6, LONG), (7, LONG + " tail"),
        (None, "no id here but words"), (8, "Ünï çödé Ünï çödé Ünï çödé"), (9, "one\ntwo\none\ntwo\n"), (10, "a" * 5000)]
