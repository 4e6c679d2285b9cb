"""The training-text pipeline: each stage takes what the one before it kept.

``run(spark, sf_dir)`` reads ``documents`` and gives the packed pieces of what is left after quality, exact and near
duplicates, and benchmark leaks. All stages but the last keep the columns of ``documents``.

Every filter tells rows apart by id and text, so repeated and null ids are judged row by row, and rows that are equal in both
share the decision (the exact stage keeps one of them). Null and empty texts are no good prose and leave in the first stage;
very long texts are handled whole by each; ties go to the largest id (exact) or the smallest (near). Empty tables pass
through all stages; further columns, whatever their names, are carried as far as packing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfmark.llm import decontaminate, exact, packing, quality, simhash
from shelfmark.llm.common import read, written


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity is that of trusted text (the labels are those of all documents)."""
    return quality.keep_good(docs, read(spark, sf_dir, "labels"))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one of the largest doc_id."""
    return exact.drop_exact_duplicates(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five-word shingles, Jaccard 0.8 or more) the one of the smallest doc_id."""
    return simhash.drop_near_duplicates(docs)


def leak_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.drop_leaks(docs, read(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of token sequences that the documents fill."""
    return packing.pack(docs, keep_ids=False).drop("ids")


STAGES = [
    ("quality classifier", quality_stage),
    ("exact dedup", exact_stage),
    ("simhash near-dedup", near_stage),
    ("benchmark decontamination", leak_stage),
    ("packing", packing_stage),
]

#: The quality model, near copies and packing are beyond SQL; the tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
