"""Access paths the index tables are laid out for."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def postings_of(postings: DataFrame, words: list[str], min_occurrences: int = 1) -> DataFrame:
    """Postings of some words. Stored sorted by word, so file statistics skip the rest."""
    return postings.filter(F.col("word").isin(words) & (F.col("keyword_occurrences") >= min_occurrences))


def keywords_by_df(keywords: DataFrame, low: int, high: int) -> DataFrame:
    return keywords.filter(F.col("documents_containing_word").between(low, high))


def most_frequent_keywords(keywords: DataFrame, count: int) -> DataFrame:
    """Top-``count`` report; each task keeps only its own candidates."""
    return keywords.orderBy(F.desc("documents_containing_word"), "word").limit(count)


def inlink_counts(links: DataFrame) -> DataFrame:
    return links.groupBy("target_website").agg(F.count(F.lit(1)).alias("inlinks"))


def outlink_counts(links: DataFrame) -> DataFrame:
    return links.groupBy("source_url").agg(F.count(F.lit(1)).alias("outlinks"))
