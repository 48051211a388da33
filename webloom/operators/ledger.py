"""Ledger of archives: which are known and which are done."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webloom.operators.merge import insert_if_absent


def seed_ledger(paths: DataFrame, ledger: DataFrame | None = None, refresh: bool = False) -> DataFrame:
    """Ledger for a list of ``file_name``; repeats in the list count once.

    An existing ledger is left as it is, so later changes of the list have no
    effect unless ``refresh`` asks for new names to be added.
    """
    fresh = paths.select("file_name").distinct().withColumn("processed", F.lit(False))
    if ledger is None:
        return fresh
    return insert_if_absent(ledger, fresh, ["file_name"]) if refresh else ledger


def pending_files(ledger: DataFrame) -> DataFrame:
    """Files still to do; a NULL flag is neither done nor pending."""
    return ledger.filter(F.col("processed") == F.lit(False)).select("file_name")


def mark_processed(ledger: DataFrame, done: DataFrame) -> DataFrame:
    """Set the flag of the ``file_name`` rows in ``done``; others keep theirs."""
    names = done.select("file_name").distinct().withColumn("_done", F.lit(True))
    return ledger.join(names, "file_name", "left").select(
        "file_name", F.coalesce("_done", "processed").alias("processed")
    )
