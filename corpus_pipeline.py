"""The corpus pipeline: documents in, packed training sequences out.

Five stages, each written to the shared folder and read again: poor texts go, near copies go, secrets are
blotted out, sources are brought to their weights, and what is left is packed into sequences.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ordermill.llm import hamming, mixing, packing, quality_gam, secret_scan
from ordermill.llm.common import documents, fold, labels, saved

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject; it learns from the labelled ones among its input."""
    model = quality_gam.train(docs, labels(spark, sf_dir), fold("doc_id", 4) != 2)
    return quality_gam.good_documents(docs, model)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity 0.8."""
    return hamming.distinct_documents(docs, hamming.FIVE_WORDS)


def blot_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with every secret replaced by its kind."""
    return secret_scan.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources brought to their target weights: rows repeat, stay or go; a source's last row is cut at its budget."""
    return mixing.mixed_documents(mixing.mix(docs))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of the mixed documents with its place in a sequence of at most 4096 tokens."""
    return packing.op3(docs)


STAGES: list[tuple[str, Stage]] = [
    ("keep_quality", keep_quality),
    ("drop_near_copies", drop_near_copies),
    ("blot_secrets", blot_secrets),
    ("mix_sources", mix_sources),
    ("pack_sequences", pack_sequences),
]

#: The classifier, the signatures and the packing are not expressible in SQL; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of documents."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
