"""Parsed pages to the index tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webloom.functions.text import MAX_KEYWORD_LENGTH, truncate_word, word_count
from webloom.operators.lemmas import lemmatise_rows
from webloom.operators.merge import accumulate, replace_children, upsert
from webloom.operators.repeats import repeated_keys
from webloom.plans.pages import indexable
from webloom.session import checked_lookup, lookup_join

REPEATED_URLS_BROADCAST = 1_000_000
FILTER_FROM = 5_000_000  # pages


@dataclass
class Index:
    """The four tables; document frequencies are kept per archive.

    Keeping the parts apart makes a second run over an archive replace its
    counts rather than add them again. ``keywords`` sums them.
    """

    websites: DataFrame
    keyword_parts: DataFrame
    postings: DataFrame
    links: DataFrame
    totals: DataFrame | None = None  # document frequencies over all archives, where they are stored
    rows: int | None = None  # upper bound on the rows of each table, where it is known

    @property
    def keywords(self) -> DataFrame:
        if self.totals is not None:
            return self.totals
        return accumulate(
            self.keyword_parts.select("word", "documents_containing_word"), ["word"], "documents_containing_word"
        )


def mark_latest(
    pages: DataFrame, key: str = "url", order: tuple[str, ...] = ("file_id", "record_no"), filter_from: int = FILTER_FROM
) -> DataFrame:
    """Add ``is_latest``: true for the last version of each key.

    Only keys seen more than once matter, and a key with very many versions is
    still one row of that list, so the pages themselves do not shuffle while the
    list is within its checked bound. From ``filter_from`` pages on, keys that occur once do not shuffle either.
    """
    lookup = checked_lookup(repeated_keys(pages, key, order, filter_from=filter_from), REPEATED_URLS_BROADCAST)
    is_latest = F.col("_last").isNull() | (F.col("_last") == F.struct(*order))
    return lookup_join(pages, lookup, key).withColumn("is_latest", is_latest).drop("_last")


def latest_pages(
    pages: DataFrame, key: str = "url", order: tuple[str, ...] = ("file_id", "record_no"), filter_from: int = FILTER_FROM
) -> DataFrame:
    return mark_latest(pages, key, order, filter_from).filter("is_latest").drop("is_latest")


def term_counts(pages: DataFrame, dictionary: DataFrame | None, limit: int = MAX_KEYWORD_LENGTH) -> DataFrame:
    """``(file_id, url, word, occurrences)`` from marked pages, one shuffle.

    Words of superseded versions stay in with zero occurrences: they count for
    document frequency, not for postings. A page is one row, so the counts are
    complete per task before they move, and frequent words cause no skew.
    """
    words = pages.select("file_id", "url", "is_latest", F.explode("tokens").alias("word"))
    if dictionary is not None:
        words = lemmatise_rows(words, dictionary)
    return (
        words.withColumn("word", truncate_word(F.col("word"), limit))
        .groupBy("file_id", "url", "word")
        .agg(F.count_if("is_latest").cast("int").alias("occurrences"))
    )


def document_frequency(terms: DataFrame) -> DataFrame:
    """Distinct URLs per archive and word; ``terms`` holds each pair once already."""
    return terms.groupBy("file_id", "word").agg(F.count(F.lit(1)).alias("documents_containing_word"))


def term_frequency(terms: DataFrame) -> DataFrame:
    return terms.filter(F.col("occurrences") > 0).select(
        "word", "url", F.col("occurrences").alias("keyword_occurrences")
    )


def website_rows(latest: DataFrame) -> DataFrame:
    return latest.select("url", "title", "description", word_count(F.col("tokens")).alias("word_count"))


def link_rows(latest: DataFrame) -> DataFrame:
    edges = latest.select(F.col("url").alias("source_url"), F.explode("links").alias("target_website"))
    return edges.distinct()


def build_index(
    pages: DataFrame,
    dictionary: DataFrame | None,
    limit: int = MAX_KEYWORD_LENGTH,
    staging: str | None = None,
) -> Index:
    """Index of a set of pages. Give it a stored table: four tables read it.

    With a ``staging`` folder the term counts, which two of the tables need, are
    written there once instead of being worked out for each.
    """
    marked = mark_latest(indexable(pages))
    latest = marked.filter("is_latest")
    terms = term_counts(marked, dictionary, limit)
    if staging:
        terms.write.mode("overwrite").parquet(f"{staging}/terms")
        terms = pages.sparkSession.read.schema(terms.schema).parquet(f"{staging}/terms")
        links = F.coalesce(F.sum(F.size(F.coalesce("links", F.array()))), F.lit(0))
        rows = max(terms.count(), pages.agg(links).first()[0])
    return Index(
        websites=website_rows(latest),
        keyword_parts=document_frequency(terms),
        postings=term_frequency(terms),
        links=link_rows(latest),
        rows=rows if staging else None,
    )


def merge_index(old: Index, new: Index, archives: DataFrame | None = None) -> Index:
    """Stored index with a batch merged in; merging the same batch twice changes nothing.

    ``archives``: the ``file_id`` of all archives in the batch, also of those without a word.
    """
    batch = new.websites.select("url")
    archives = new.keyword_parts if archives is None else archives
    return Index(
        websites=upsert(old.websites, new.websites, ["url"]),
        keyword_parts=replace_children(
            old.keyword_parts, new.keyword_parts, archives.select("file_id"), ["file_id"]
        ),
        postings=replace_children(old.postings, new.postings, batch, ["url"]),
        links=replace_children(
            old.links, new.links, batch.select(F.col("url").alias("source_url")), ["source_url"]
        ),
    )


def recompute_keywords(postings: DataFrame) -> DataFrame:
    """Document frequency as the stored postings have it, without past versions."""
    return postings.groupBy("word").agg(F.count(F.lit(1)).alias("documents_containing_word"))
