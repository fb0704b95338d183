"""A corpus pipeline: toxic documents, exact copies, near copies and benchmark items go; the rest is encoded.

Every stage takes (spark, docs, sf_dir) and works on all that its predecessor kept. A stage's
result is written as Parquet and read again as the next one's documents.

Defined results: columns that a stage does not read may be null and have any names; a null text
counts as empty (each stage's module says what that gives); of rows that repeat id and text one
stays; rows without an id are kept unless another row of their group has one; texts of any length are
read whole; of equal ids in a group of equal texts one row stays; an empty table gives an empty
result from every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cohortloom.llm import decontaminate, exact_dedup, simhash_dedup, toxicity
from cohortloom.llm.common import documents
from cohortloom.llm.queries import bpe_digests, toxicity_model
from cohortloom.session import shared_folder


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score stays below the threshold; the model learns from labels of ``docs``."""
    return toxicity.drop_toxic(docs, toxicity_model(spark, docs, sf_dir))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the smallest doc_id."""
    return exact_dedup.drop_exact_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts linked by fingerprints at 4 or fewer of 64 bits, over four-word shingles, the row with the smallest doc_id."""
    return simhash_dedup.drop_near_duplicates(docs, simhash_dedup.RADIUS)


def drop_benchmark_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    return decontaminate.drop_contaminated(docs, documents(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of each document's byte-level BPE ids and of their decoded bytes."""
    return bpe_digests(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("benchmark_decontamination", drop_benchmark_items),
    ("byte_bpe", encode),
]

#: The stages' models and graph search are no SQL; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table of documents."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        folder = f"{shared_folder(spark)}/{name}"
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return docs
