"""A table of pages seen as crawl records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RESPONSE_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"


def pages_as_records(pages: DataFrame, file_id: Column) -> DataFrame:
    """``(page_id, url, html)`` rows as records with an HTTP response for a body.

    ``file_id`` says which archive a page belongs to; ``page_id`` orders the
    records inside it.
    """
    body = F.concat(F.lit(RESPONSE_HEAD), "html").cast("binary")
    return pages.select(
        file_id.alias("file_id"),
        F.col("page_id").alias("record_no"),
        F.lit("response").alias("warc_type"),
        F.col("url").alias("target_uri"),
        F.lit(None).cast("string").alias("warc_date"),
        F.lit("text/html").alias("payload_type"),
        F.octet_length(body).cast("long").alias("content_length"),
        body.alias("body"),
    )
