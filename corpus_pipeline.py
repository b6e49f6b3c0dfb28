"""A cleaning pipeline over ``documents``: each stage is one operator, written and read again by the next.

Stages take (spark, docs, sf_dir) and return a DataFrame; all but the last return the columns of ``documents``, whatever
others there are. Rows count, not ids: a null or repeated doc_id neither keeps a row in nor takes another out. Null, empty
and very long texts pass all stages whole; null and empty ones are neither toxic nor copies. Empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from refloom.llm import decontamination, minhash, packing, pii, toxicity
from refloom.llm.common import Scratch, table


def toxic_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learns from all labels and drops documents that score 0.5 or more."""
    model = toxicity.learn(spark, docs, table(spark, sf_dir, "labels"))
    return toxicity.accepted(docs, model)


def near_duplicates_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of near copies (five words, 0.8): that with the smallest doc_id."""
    return minhash.deduplicated(spark, docs, percent=80, rows=5, n_bands=20)


def benchmark_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark passage."""
    return decontamination.clean(spark, docs, table(spark, sf_dir, "benchmark"))


def personal_data_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Puts a mark in the place of personal data, and counts characters again."""
    return pii.mask(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of full training sequences."""
    return packing.pack(spark, docs)


STAGES = [("toxicity", toxic_out), ("near_duplicates", near_duplicates_out), ("decontamination", benchmark_out), ("personal_data", personal_data_out), ("packing", packed)]
ORACLE_SQL = None  # a fitted model and a tokenizer decide; tests hold it against a brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch, docs = Scratch(spark, "pipeline"), table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        old, docs = docs, stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = scratch.save(docs)
            if i:
                scratch.drop(old)
            scratch.release()
    return docs
