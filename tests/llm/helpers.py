"""Documents that every operator must survive, and small plain versions."""

from __future__ import annotations

from pyspark.sql import types as T

#: Extra columns whose names operators might use themselves.
CLASHES = ["row", "fp", "key", "size", "target", "taken", "score", "predicted", "kept", "digest", "label", "offset",
           "component_id", "win_id", "run", "tokens"]
SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                       T.StructField("n_chars", T.LongType()), *[T.StructField(c, T.StringType()) for c in CLASHES]])


def documents(spark, rows):
    """``rows`` of (doc_id, text[, source]) with nulls elsewhere and clashing extra columns."""
    full = [(r[0], r[1], None, r[2] if len(r) > 2 else None, None, *["x"] * len(CLASHES)) for r in rows]
    return spark.createDataFrame(full, SCHEMA)


def awkward(spark):
    words = "the quick brown fox jumps over a lazy dog while nobody looks at it"
    return documents(spark, [
        (1, None, "a"), (2, "", "a"), (3, "  \t\n ", None), (4, words, "b"), (4, words, "b"), (5, words + " ", "a"),
        (None, words, "a"), (None, None, None), (6, "é ß 中文 😀   x", "b"), (7, "a", None),
        (8, "long " * 300_000, "a"), (9, "x" * 1_500_000, "a"), (10, words.upper(), "b")])


def empty(spark):
    return documents(spark, [])
