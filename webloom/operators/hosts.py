"""Ranked site list and the filter of records on it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webloom.functions.urls import url_host
from webloom.session import Lookup, checked_lookup, lookup_join
from webloom.sources.lines import first_lines

SITE_LIMIT = 100_000  # fixed value: lines of the site list that count
BROADCAST_LIMIT = 1_000_000


def site_allowlist(lines: DataFrame, limit: int = SITE_LIMIT) -> DataFrame:
    """Distinct hosts among the first ``limit`` lines: cut first, then dedupe."""
    return first_lines(lines, limit).select(F.col("line").alias("host")).distinct()


def with_host(records: DataFrame, url: str = "target_uri") -> DataFrame:
    return records.withColumn("host", url_host(F.col(url)))


def _listed_hosts(known: DataFrame, allowlist: DataFrame, max_broadcast: int) -> Lookup:
    """``(host, listed)``: the list, or if it is too long to broadcast, what these records need of it."""
    lookup = checked_lookup(allowlist.select("host", F.lit(True).alias("listed")), max_broadcast)
    if lookup.small:
        return lookup
    present = known.select("host").filter(F.col("host").isNotNull()).distinct()
    return checked_lookup(present.join(lookup.rows, "host"), max_broadcast)


def with_listed(records: DataFrame, allowlist: DataFrame, max_broadcast: int = BROADCAST_LIMIT) -> DataFrame:
    """Add ``host`` and ``listed``; the list is matched as it is written."""
    known = with_host(records)
    joined = lookup_join(known, _listed_hosts(known, allowlist, max_broadcast), "host")
    return joined.withColumn("listed", F.coalesce("listed", F.lit(False)))


def filter_hosts(records: DataFrame, allowlist: DataFrame, max_broadcast: int = BROADCAST_LIMIT) -> DataFrame:
    """Records whose host is listed, matched as written on the list.

    A list of checked size goes to every task and records do not shuffle. Of a longer one,
    the hosts that the records have are found first, and only those are joined.
    """
    known = with_host(records).filter(F.col("host").isNotNull())
    lookup = _listed_hosts(known, allowlist, max_broadcast)
    hosts = lookup.rows.select("host")
    return known.join(F.broadcast(hosts) if lookup.small else hosts, "host", "left_semi")
