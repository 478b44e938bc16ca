"""The corpus pipeline: documents in, packed sequences out.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
it as Parquet to the shared folder and hands the table to the next stage. All
stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from obsflow.llm import languages, mixing, packing, secrets, simhash
from obsflow.llm.common import documents, staged
from obsflow.llm.registry import query


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without text in one of the languages learned from the labelled ones go."""
    return languages.in_a_language(docs, languages.learn_from_documents(docs))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates one row stays, of the document with the smallest id."""
    return simhash.one_of_each(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by their kind; documents without any stay as they are."""
    return secrets.redacted(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it."""
    return mixing.repeated(mixing.mix(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of sequences that the documents are packed into."""
    return packing.digest(packing.pack(docs))


STAGES = [
    ("language ID", language_id),
    ("SimHash near-dedup", simhash_near_dedup),
    ("secret scan", secret_scan),
    ("mixing sources", mix_sources),
    ("packing", pack),
]

#: The stages draw, hash and tokenize in ways SQL has no words for; tests/llm/test_pipeline.py has the brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = staged(docs, f"stage-{number}")
    return docs


query("pipeline", ORACLE_SQL)(run)
