"""Small tables that every corpus operator has to bear."""

from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("keys", T.StringType()),
        T.StructField("_chunk", T.StringType()),
    ]
)
LONG = "the quick brown fox jumps over one lazy dog and then some more. "
AWKWARD = [None, "", " ", "\n\n", "a", LONG * 400, "é" * 5000, "x" * 20_000, "tab\there\r\nand  double   spaces \x1c\x85 end ", "日本語 text ½ ² 'll 'S don't"]


def docs(spark, texts, ids=None):
    """A table of these texts with columns whose names clash with those the operators use themselves."""
    ids = list(range(1, len(texts) + 1)) if ids is None else ids
    rows = [(i, t, None, "k", None) for i, t in zip(ids, texts, strict=True)]
    return spark.createDataFrame(rows, DOCS)
