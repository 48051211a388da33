"""Counters of a scan, by archive."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webloom.functions.html import page_udf
from webloom.functions.http import response_parts
from webloom.operators.hosts import BROADCAST_LIMIT, with_listed
from webloom.operators.language import LanguageModel


def scan_counters(
    records: DataFrame,
    allowlist: DataFrame,
    model: LanguageModel,
    max_broadcast: int = BROADCAST_LIMIT,
    language: str = "en",
) -> DataFrame:
    """``(file_id, read_ok, matching, valid)``.

    A record matches when its host is listed and its body decodes, whatever its
    type; it is valid when it is also a page in the language. One pass over the
    records: with a list small enough to broadcast only counts shuffle.
    """
    text = F.col("body").cast("string")
    matching = F.coalesce(F.col("listed") & F.is_valid_utf8(text), F.lit(False))
    flagged = with_listed(records, allowlist, max_broadcast).withColumn("_matching", matching)
    page_text = flagged.withColumn("body_text", F.when(F.col("_matching"), text))
    parsed = response_parts(page_text).withColumn("_page", page_udf(model)("html_body"))
    return parsed.groupBy("file_id").agg(
        F.count(F.lit(1)).alias("read_ok"),
        F.count_if("_matching").alias("matching"),
        F.count_if(F.col("_page.lang") == language).alias("valid"),
    )
