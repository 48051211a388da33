"""The queries of this package over the provided tables, and their SQL where it can express them."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline

from webloom.llm import op1_toxicity as op1
from webloom.llm import op10_pii as op10
from webloom.llm import op11_prefix_trie as op11
from webloom.llm import op12_chat_format as op12
from webloom.llm import op13_lexical_search as op13
from webloom.llm import op2_decontamination as op2
from webloom.llm import op3_jaccard_join as op3
from webloom.llm import op4_mixing as op4
from webloom.llm import op5_token_counts as op5
from webloom.llm import op6_substring_dedup as op6
from webloom.llm import op7_fingerprint as op7
from webloom.llm import op8_quality as op8
from webloom.llm import op9_suffix_dedup as op9
from webloom.llm.storage import bounded_batches, shared_folder, spread_scan, table


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    docs = spread_scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return op1.toxicity_report(docs, table(spark, sf_dir, "labels"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    docs = spread_scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return op2.leak_report(docs, table(spark, sf_dir, "benchmark"))


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    docs = spread_scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return op3.similar_groups(docs, k=3, num=90, den=100)


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op4.mix_report(table(spark, sf_dir, "documents"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    docs = spread_scan(table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text"))
    folder = f"{shared_folder(spark)}/rollup-{uuid.uuid4().hex}"
    return op5.rollup_of(docs, table(spark, sf_dir, "labels"), folder, op5.Tokenizer("byte_bpe_50k"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return op6.repeated_passages(spread_scan(table(spark, sf_dir, "documents").select("doc_id", "text")))


def op7_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op7.fingerprint_report(table(spark, sf_dir, "documents"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    docs = spread_scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return op8.quality_report(docs, table(spark, sf_dir, "labels"))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return op9.dedup_report(spread_scan(table(spark, sf_dir, "documents").select("doc_id", "text")))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return op10.pii_report(spread_scan(table(spark, sf_dir, "documents").select("doc_id", "text")))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return op11.trie_report(spread_scan(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")))


def op12_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op12.chat_report(op12.with_probe(spread_scan(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"))))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    docs = spread_scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return op13.search(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"))


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_decontamination": op2_decontamination,
    "op3_jaccard_join": op3_jaccard_join,
    "op4_mixing": op4_mixing,
    "op5_token_counts": op5_token_counts,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_fingerprint": op7_fingerprint,
    "op8_quality": op8_quality,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_pii": op10_pii,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_chat_format": op12_chat_format,
    "op13_lexical_search": op13_lexical_search,
    "pipeline": corpus_pipeline.run,
}

SQL = {
    "op2_decontamination": op2.SQL,
    "op3_jaccard_join": op3.SQL,
    "op4_mixing": op4.SQL,
    "op9_suffix_dedup": op9.SQL,
    "op11_prefix_trie": op11.SQL,
    "op12_chat_format": op12.SQL,
    "op13_lexical_search": op13.SQL,
}
