"""Rows that operators must bear: nulls everywhere, empty and long texts, repeated rows, clashing columns."""

from pyspark.sql import types as T

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # Names that operators give to columns of their own.
        T.StructField("score", T.StringType()),
        T.StructField("size", T.StringType()),
        T.StructField("n_tokens", T.StringType()),
        T.StructField("node", T.StringType()),
        T.StructField("copy", T.StringType()),
    ]
)
LONG = "the quick brown fox jumps over the lazy dog " * 30_000
CLASH = ("clash",) * 5
ODD = [
    (1, None, "en", "a", 0, *CLASH),
    (2, "", "en", None, 0, *CLASH),
    (3, LONG, None, "a", len(LONG), *CLASH),
    (4, "One small text with seven words in.", "en", "b", None, *CLASH),
    (4, "One small text with seven words in.", "en", "b", None, *CLASH),
    (5, "one SMALL text, with seven words in", "en", None, 3, *CLASH),
    (None, "A row without an id at all.", None, None, None, *CLASH),
    (None, None, None, None, None, None, None, None, None, None),
    (6, " \n\t ", "fr", "b", 4, *CLASH),
    (7, "12345 !!! ???", "de", "b", 4, *CLASH),
    (8, "two words", "es", "c", 9, *CLASH),
]


def odd_documents(spark):
    return spark.createDataFrame(ODD, SCHEMA)


def no_documents(spark):
    return spark.createDataFrame([], SCHEMA)


def labels(spark, rows=()):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")


def rows_of(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]
