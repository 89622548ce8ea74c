"""Documents with every odd case: nulls, empty and long texts, repeated rows, missing ids, columns with clashing names."""

from pyspark.sql import types as T

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                       T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()), T.StructField("id", T.StringType()),
                       T.StructField("key", T.IntegerType()), T.StructField("label", T.StringType()), T.StructField("rep", T.StringType()),
                       T.StructField("score", T.StringType()), T.StructField("digest", T.StringType())])


def frame(spark, rows):
    """(id, text) pairs as documents with further columns."""
    return spark.createDataFrame([(i, t, None, "s", None if t is None else len(t), "x", 1, None, "r", "q", "d") for i, t in rows], SCHEMA)


def words(start: int, n: int) -> str:
    return " ".join(f"w{k}" for k in range(start, start + n))


ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, words(0, 60)), (6, words(0, 60)), (6, words(0, 60)), (None, words(0, 60)), (None, None),
       (7, "ß é 漢字 ▁ \U0001F600 \x01"), (8, "x" * 30_000), (9, words(500, 6000))]
