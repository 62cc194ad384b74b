"""The corpus pipeline: five stages over ``documents``, each a filter or a check by one operator.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; the runner
writes it as Parquet and reads it back as the next stage's documents. All but
the last stage return the columns of ``documents``.

A null text counts as empty in every stage, and a null in another column passes
through; empty texts, very long texts and rows without doc_id are judged like any
other. Rows that repeat are judged alike, until near-dedup keeps one of them. Empty
tables give no rows; extra columns pass through whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trafficlens.llm.bpe import digests, encode_documents
from trafficlens.llm.common import table, text_or_empty, written
from trafficlens.llm.decontamination import drop_contaminated
from trafficlens.llm.neardup import keep_one_of_each
from trafficlens.llm.quality import keep_accepted
from trafficlens.llm.toxicity import keep_clean

RANKS = "byte_bpe_50k.tiktoken"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches the acceptance level; all of them without labels of both classes."""
    return keep_accepted(docs, table(spark, sf_dir, "labels"))


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a toxic window; all of them without labels of both classes."""
    return keep_clean(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates, the one with the least doc_id; texts without words are one class."""
    return keep_one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found; an empty benchmark, or items without words, drop none."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256, ids, round_trip): token ids, and whether they decode to the text."""
    import public_tokenizers

    path = public_tokenizers.path(RANKS)
    marked = docs.withColumn("text_sha256", F.sha2(text_or_empty(), 256))
    both = encode_documents(marked, path, public_tokenizers.PATTERN, keep=("text_sha256",), decode=True)
    both = both.select("doc_id", *digests(), "ids", "text_sha256")
    return both.withColumn("round_trip", F.col("decoded_sha256") == F.col("text_sha256")).drop("text_sha256")


STAGES = [
    ("quality classifier", quality),
    ("toxicity", toxicity),
    ("minhash near-dedup", near_dedup),
    ("benchmark decontamination", decontaminate),
    ("byte-level bpe", tokenize),
]

#: Models, sketches and merges are not SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``, each result written as Parquet and reread."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = written(docs, f"pipeline_{number}")
    return docs
