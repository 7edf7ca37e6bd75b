"""A corpus pipeline over ``documents``: toxicity, near-duplicates, benchmark decontamination, secrets, packing.

Every stage takes (spark, docs, sf_dir), works on all rows its predecessor kept, and returns a DataFrame that is
written as Parquet and read again for the next one. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gridmix.llm import decontam, packing, secrets, similar, toxicity
from gridmix.llm.common import small_batches, staged, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is 0.7 or more go."""
    return toxicity.clean(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of texts with four fifths of their five-word shingles in common the least doc_id stays."""
    small_batches(spark)
    return similar.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold four fifths or more of a benchmark item go."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay, their secrets masked."""
    import public_tokenizers

    small_batches(spark)
    return secrets.mask_secrets(docs, public_tokenizers.path(secrets.VOCABULARY))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents and their places in training sequences."""
    import public_tokenizers

    small_batches(spark)
    return packing.pack(docs, public_tokenizers.path(packing.VOCABULARY))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", mask_secrets),
    ("packing", pack_sequences),
]

#: The stages need a fitted model, XXH64 and a tokenizer, which SQL has not; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir))
    return docs
