"""The corpus pipeline: documents through five of the text operators, one written table after another."""

from pyspark.sql import DataFrame, SparkSession

from imagelab.llm.common import table
from imagelab.llm.exact_dedup import drop_exact_duplicates
from imagelab.llm.mixing import mix_documents
from imagelab.llm.packing import pack_documents
from imagelab.llm.simhash import drop_near_duplicates
from imagelab.llm.toxicity import drop_toxic, fit_scorer
from imagelab.session import materialise


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that are not predicted toxic; the scorer learns from `labels` over these documents."""
    return drop_toxic(docs, fit_scorer(docs, table(spark, sf_dir, "labels")))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return drop_exact_duplicates(docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return drop_near_duplicates(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of all sources by weight: each document as often as the mix takes it, from 0 to 2 times."""
    return mix_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset): the mix in sequences of tokens."""
    return pack_documents(docs, added_tokens=True).withColumnRenamed("id", "doc_id")


STAGES = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("simhash_dedup", simhash_dedup),
    ("mixing", mixing),
    ("packing", packing),
]

ORACLE_SQL = None  # no SQL for the trained tagger and the fingerprints; tests compare with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on `documents`; each result is written and read again as the next one's input."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return docs
