"""Small fixtures for the training-data operators, built row by row."""

import random

from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])
WORDS = [f"{a}{b}{c}" for a in ("ka", "lo", "mi", "ter", "sun") for b in ("ra", "ne", "to", "vi") for c in ("", "n", "s", "ly")]


def docs(spark, rows):
    """Rows of ``(doc_id, text[, lang[, source]])`` as a documents table."""
    full = [(*r, *[None] * (4 - len(r)), None if r[1] is None else len(r[1])) for r in rows]
    return spark.createDataFrame(full, DOCS).repartition(3)


def prose(seed, n):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) for _ in range(n))


ODD_TEXTS = [None, "", "   \n\t", "one", "two words", "é ñ", "中文 字", "a b c", "x" * 5000, "the the the the the the the the"]
