"""A pipeline from raw documents to packed sequences: five stages, each an operator over all that the last one kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from siltbed.llm import exact_dedup, jaccard_join, mixing, packing, quality, queries
from siltbed.llm._common import dropped, staged, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the neighbour vote does not reject."""
    return quality.kept(docs, queries.quality_model(docs, table(spark, sf_dir, "labels")), queries.GOOD_ENOUGH)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, that of the largest id."""
    return exact_dedup.without_copies(docs, keep="max")


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that of the least id: sets of five words, similarity of 0.8 or more."""
    return jaccard_join.without_near_copies(docs, width=5, percent=80)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixture(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, with their token ids, in sequences of at most 2048 tokens; doc_row tells copies apart."""
    return packing.pack(docs, queries.WORD_BPE, with_ids=True)


STAGES = [
    ("quality", quality_stage),
    ("exact_dedup", exact_stage),
    ("jaccard_join", near_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

#: SQL cannot express the first, third and last stage; the tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage. Each stage's table goes once the next one is written; that of the last but one is still read."""
    docs, last = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if last is not None:
            dropped(last)
        last = docs
    return STAGES[-1][1](spark, docs, sf_dir)
