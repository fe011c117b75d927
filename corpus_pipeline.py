"""A training-data pipeline over documents: STAGES in order, each on what its predecessor kept."""

from __future__ import annotations

import uuid
from fractions import Fraction

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellgrid.llm import line_dedup, ngram_join, packing, pii, queries, toxicity
from cellgrid.llm.packed import free_name
from cellgrid.session import read_table, shared_folder


#: Words that a packing task remembers; less than the operator's own default, as its workers served other stages before.
CACHED_WORDS = 150_000


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain, trained on the labelled rows, doesn't reject.

    All columns stay, whatever their names; a null text counts as empty and stays null, ids play no part, repeated rows go or
    stay together, and an empty table stays empty."""
    chain = toxicity.train(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return toxicity.accept(docs, chain)


def without_common_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the lines that five documents or more share (the last of them keeps its own).

    All columns stay, those named like the operator's own too. A null text becomes empty; a null id is smaller than any other;
    rows of one id keep or lose their lines alike; an empty table stays empty."""
    aside = {c: free_name(f"own_{c}", docs.columns) for c in docs.columns if c.lower() in line_dedup.NEW}
    done = line_dedup.dedup_lines(docs.withColumnsRenamed(aside))
    done = done.withColumn("text", F.col("kept_text")).drop(*line_dedup.NEW)
    return _measured(done.withColumnsRenamed({own: c for c, own in aside.items()}), docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of texts linked by five-word shingles at 0.8 or more.

    All columns stay. Null and blank texts are linked with nothing; rows of one id go or stay together; of rows without an id,
    those linked with an id go; an empty table stays empty."""
    return ngram_join.keep_one(docs, words=5, threshold=Fraction(4, 5))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, personal data masked.

    All columns stay, whatever their names. A null text becomes empty; ids play no part; an empty table stays empty."""
    return _measured(pii.redact(docs, queries.tagger()), docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces in sequences of at most 4096 tokens.

    A null or empty text is its closing id alone; rows without an id or with one id are documents of their own; columns beside
    id and text play no part; an empty table gives no rows."""
    with open(queries.tokenizer_path("word_bpe_49k.json"), encoding="utf-8") as f:
        return packing.pack(docs, f.read(), cached_words=CACHED_WORDS)


def _measured(done: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of docs, the text's length anew."""
    return done.withColumn("n_chars", F.length("text").cast("long")).select(*[f"`{c}`" for c in docs.columns])


STAGES = [
    ("toxicity", without_toxic),
    ("line dedup", without_common_lines),
    ("n-gram Jaccard join", without_near_copies),
    ("personal data", without_personal_data),
    ("packing", packed),
]

#: SQL expresses neither a trained classifier nor a tagger; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to documents. Each stage's rows but the last's are written to the shared folder and read again, so
    that a stage's work is done once, whatever the next ones ask of it."""
    docs = read_table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs.write.parquet(f"{folder}/{k}")
            docs = spark.read.parquet(f"{folder}/{k}")
    return docs
