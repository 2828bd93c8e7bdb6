"""A training corpus from ``documents`` in five stages.

Each stage works on all rows that its predecessor kept and is written as Parquet
before the next one reads it.

Odd rows: a null text is an empty one; a row without a ``doc_id`` or with one that
others have is a row like any other (SimHash chooses by text, then the others keep or
drop it by its own text); repeated rows are copies, of which SimHash keeps one; an
empty table passes through all stages; further columns of any name come along, up to
the last stage, which gives the digests of the encoded texts alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from salesboard.llm import bpe, decontam, pii, quality, simhash
from salesboard.llm.common import documents, written


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: documents that the quality classifier rejects go."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: one row of each group of near copies stays, the one with the smallest id (rows without one last)."""
    return simhash.keep_one(docs, shingle=3, most=3)


def decontam_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: documents that leak a benchmark item go."""
    return decontam.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: personal data is replaced by its kind, revealing words are generalised or removed."""
    return pii.sanitise(docs)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: ``doc_id, n_tokens, ids_sha256, decoded_sha256`` of the texts encoded and decoded."""
    return bpe.round_trip(docs)


STAGES = [
    ("quality", quality_stage),
    ("simhash", simhash_stage),
    ("decontam", decontam_stage),
    ("pii", pii_stage),
    ("bpe", bpe_stage),
]

#: No SQL: the classifier, the fingerprints and the encoder have none.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
