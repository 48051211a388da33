"""Crawl records to parsed pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webloom.functions.html import page_udf
from webloom.functions.http import html_responses
from webloom.functions.markup import hrefs_of, page_tags, title_of
from webloom.functions.text import tokens
from webloom.functions.urls import page_links
from webloom.operators.language import LanguageModel


def page_parts(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Add ``title``, ``description`` and ``links``, as column expressions. Rows without HTML are left out. The description
    is the title by definition of this index."""
    found = pages.filter(F.col(html) != "").withColumn("_tags", page_tags(F.col(html)))
    links = page_links(F.col(url), hrefs_of(F.col("_tags"))).alias("links")
    return found.select(*pages.columns, title_of(F.col("_tags")).alias("title"), links).select(
        *pages.columns, "title", F.col("title").alias("description"), "links"
    )


def page_text(pages: DataFrame, model: LanguageModel | None = None, html: str = "html") -> DataFrame:
    """Add ``text_body`` and ``lang`` in one Arrow pass; other columns never leave the JVM. Rows without HTML are left out."""
    parsed = pages.withColumn("_page", page_udf(model)(F.col(html)))
    return parsed.filter(F.col("_page").isNotNull()).select(
        *pages.columns, F.col("_page.text").alias("text_body"), F.col("_page.lang").alias("lang")
    )


def parse_html(
    pages: DataFrame, model: LanguageModel | None = None, url: str = "url", html: str = "html", language: str | None = None
) -> DataFrame:
    """Add ``text_body``, ``lang``, ``title``, ``description`` and ``links``, the last three to pages of the language only,
    if one is given."""
    texts = page_text(pages, model, html)
    if language is not None:
        texts = texts.filter(F.col("lang") == language)
    return page_parts(texts, url, html)


def parse_pages(records: DataFrame, model: LanguageModel | None, language: str | None = "en") -> DataFrame:
    """Records to pages in one language, with their tokens.

    The cheap JVM filters (valid UTF-8, HTML type) come before the parser, the
    tokens only after the language gate. With ``language=None`` all pages stay.
    """
    pages = parse_html(html_responses(records), model, "target_uri", "html_body", language)
    return pages.select(
        "file_id",
        "record_no",
        "warc_date",
        F.col("target_uri").alias("url"),
        F.col("payload_type").alias("warc_identified_payload_type"),
        "status_code",
        "content_type",
        "content_length",
        "html_body",
        "title",
        "description",
        "links",
        "text_body",
        "lang",
        tokens(F.col("text_body")).alias("tokens"),
    )


def indexable(pages: DataFrame) -> DataFrame:
    """Pages with a title, a description and a URL."""
    return pages.dropna(subset=["title", "description", "url"])
