"""The corpus pipeline: five stages over ``documents``, each written as a table and read by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webloom.llm import op1_toxicity, op2_decontamination, op3_jaccard_join, op4_mixing, op10_pii
from webloom.llm.storage import bounded_batches, stored, table


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Toxic documents go. Learned from the labels that the operator's query learns from."""
    bounded_batches(spark)
    labels = table(spark, sf_dir, "labels")
    model = op1_toxicity.train(docs, labels.filter(~op1_toxicity.held_out(F.col("doc_id"), 4, 2)))
    return op1_toxicity.drop_toxic(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: five words, a similarity of 0.8 or more."""
    bounded_batches(spark)
    return op3_jaccard_join.keep_one_of_each(docs, k=5, num=8, den=10)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    bounded_batches(spark)
    return op2_decontamination.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data are masked; every document stays."""
    bounded_batches(spark)
    return op10_pii.mask(docs, op10_pii.train(docs))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of the mix with the words taken of each; over its size means it is repeated."""
    return op4_mixing.mix(docs)


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("mixing", mixing),
]

# Neither a learned score nor the field's spans can be said in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs
