"""Merging a new batch into stored tables, as joins and unions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from webloom.session import Lookup, lookup_join


def insert_if_absent(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """``old`` plus the rows of ``new`` whose key it lacks, one per key."""
    fresh = new.dropDuplicates(keys).join(old.select(keys), keys, "left_anti")
    return old.unionByName(fresh)


def upsert(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``new`` (one per key) and the rows of ``old`` they do not replace."""
    return replace_children(old, new, new.select(keys), keys)


def replace_children(old: DataFrame, new: DataFrame, batch_keys: DataFrame, keys: list[str]) -> DataFrame:
    """Drop all stored rows of the parents in the batch, then add the new ones.

    A parent that lost all its rows is in ``batch_keys`` but not in ``new``. The
    keys carry no hint: they are broadcast if their measured size allows, so the
    stored table is then only scanned, and otherwise both sides shuffle.
    """
    kept = old.join(batch_keys.select(keys).distinct(), keys, "left_anti")
    return kept.unionByName(new.select(old.columns))


def accumulate(parts: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Sum of the parts per key; partial sums are taken before the shuffle."""
    return parts.groupBy(*keys).agg(F.sum(value).alias(value))


def dense_ids(rows: DataFrame, key: str, id_name: str = "id", keys_per_bucket: int = 100_000) -> DataFrame:
    """Ids 1..n without gaps for the distinct values of ``key``.

    Keys are numbered inside hash buckets and each bucket starts where the ones
    before it end. There are as many buckets as the estimated number of keys needs. The running sum
    covers one row per bucket; no window ever sees the whole table.
    """
    known = rows.select(F.approx_count_distinct(key)).first()[0]
    buckets = max(16, -(-known // keys_per_bucket))
    keys = rows.select(key).distinct().withColumn("_bucket", F.pmod(F.xxhash64(key), F.lit(buckets)))
    sizes = keys.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_size"))
    starts = sizes.select(
        "_bucket",
        (F.sum("_size").over(Window.orderBy("_bucket")) - F.col("_size")).alias("_start"),
    )
    place = F.row_number().over(Window.partitionBy("_bucket").orderBy(key))
    return (
        keys.withColumn("_place", place)
        .join(F.broadcast(starts), "_bucket")
        .select(key, (F.col("_start") + F.col("_place")).alias(id_name))
    )


def postings_by_id(postings: DataFrame, words: Lookup, urls: Lookup) -> DataFrame:
    """``(keyword_id, website_id, keyword_occurrences)`` for postings by natural key."""
    named = lookup_join(lookup_join(postings, words, "word"), urls, "url")
    return named.select("keyword_id", "website_id", "keyword_occurrences")


def postings_by_key(by_id: DataFrame, words: Lookup, urls: Lookup) -> DataFrame:
    """The reverse: ids back to word and URL."""
    named = lookup_join(lookup_join(by_id, words, "keyword_id"), urls, "website_id")
    return named.select("word", "url", "keyword_occurrences")
