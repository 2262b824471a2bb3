"""Rows that every text operator must handle, and tables made of them."""

from pyspark.sql import types as T

LONG = " ".join(f"word{i % 997} other{i % 89}." for i in range(12_000))

#: doc_id, text, lang, source; null and repeated ids, null, empty and blank texts, repeated rows, ties, a very long text.
EDGE = [
    (1, "The quick brown fox jumps over the lazy dog. It then sleeps for a very long while in the warm sun.", "en", "a"),
    (2, None, "en", "a"),
    (3, "", "fr", "b"),
    (4, " \t\n ", None, None),
    (5, LONG, "en", "b"),
    (6, LONG, "en", "b"),
    (7, "The quick brown fox jumps over the lazy dog. It then sleeps for a very long while in the warm sun.", "en", "a"),
    (7, "The quick brown fox jumps over the lazy dog. It then sleeps for a very long while in the warm sun.", "en", "a"),
    (7, "Un autre texte sans rapport avec le premier, mais avec le même numéro que celui-ci.", "fr", "b"),
    (None, "The quick brown fox jumps over the lazy dog. It then sleeps for a very long while in the warm sun.", None, "c"),
    (None, None, None, None),
    (8, "123 456 789 !!!", "en", None),
]

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
    ]
    # Names that the operators use inside.
    + [T.StructField(name, T.StringType()) for name in ("id", "t", "key", "rank", "row", "h", "print", "size", "skey", "host", "chunk")]
)


def documents(spark, rows, parts: int = 3):
    padded = [(*r, *["clash"] * (len(SCHEMA) - len(r))) for r in rows]
    return spark.createDataFrame(padded, SCHEMA).repartition(parts) if padded else spark.createDataFrame([], SCHEMA)


def edge(spark):
    return documents(spark, EDGE)


def empty(spark):
    return documents(spark, [])
