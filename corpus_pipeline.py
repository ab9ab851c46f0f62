"""From raw documents to packed sequences: five stages, each over all that the one before kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tallyseq.llm import mixing, near_copies, packing, quality_rules, ranker
from tallyseq.llm.queries import PACK_TOKENIZER
from tallyseq.session import materialize

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def quality_rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no base limit and no learned rule rejects."""
    return quality_rules.keep_good(docs.select(*COLUMNS), quality_rules.fit(docs, _labels(spark, sf_dir)))


def quality_classifier_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that rank at or above the cut.

    The ranking is learned from labelled documents of the whole table: those that the
    stage before kept may hold too few bad ones to prefer others to.
    """
    every = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return ranker.keep_good(docs.select(*COLUMNS), ranker.fit(every, _labels(spark, sf_dir)))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: SimHash blocks over five-word shingles, then bands for what they miss; exact similarity of 0.8 or more."""
    return near_copies.keep_one(docs.select(*COLUMNS))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its source's target takes it."""
    return mixing.mix_documents(docs.select(*COLUMNS))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their places in sequences."""
    return packing.pack(docs.select(*COLUMNS), public_tokenizers.path(PACK_TOKENIZER))


STAGES = [
    ("quality_rules", quality_rules_stage),
    ("quality_classifier", quality_classifier_stage),
    ("near_dedup", near_dedup_stage),
    ("source_mixing", mixing_stage),
    ("best_fit_packing", packing_stage),
]

#: Hashing, learning and tokenizing are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = materialize(docs)
    return docs
