"""The corpus pipeline: quality classifier, near-dedup, decontamination, secret masking, packing.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; all but the last
return the columns of documents. Stages are written as Parquet and reread, so a lost executor costs
no more than its part of one stage.

Defined results: a null text counts as an empty one in every stage; rows with a null doc_id go
through all stages; of repeated rows the near-dedup keeps one; columns beside those of documents
stay until packing, whose result has its own; an empty table passes all stages empty. The
modules of the operators say what each does with very long texts and ties.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from postmart.llm import contamination, credentials, near_dup, packing, quality
from postmart.llm.common import cut, small_batches, table
from postmart.llm.queries import tokenizer


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorisation machine rejects go."""
    return quality.keep_quality(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays, the one with the smallest doc_id."""
    small_batches(spark)
    return near_dup.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose tiles cover a benchmark item go."""
    return contamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret found is masked in its text; all documents stay."""
    small_batches(spark)
    return credentials.mask_secrets(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token pieces of what is left, each with its sequence and offset."""
    small_batches(spark)
    return packing.best_fit_pack(docs, tokenizer())


STAGES = [("quality classifier", quality_classifier), ("near dedup", near_dedup), ("decontamination", decontamination),
          ("secret scan", secret_scan), ("best-fit packing", best_fit_packing)]

#: No stage but the last could be put into SQL; the tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
