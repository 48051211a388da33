"""Checks that stand in for the constraints a database would enforce."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def audit_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows ``n``."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def audit_fk(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows with a key that no parent row has; a NULL key passes."""
    parents = parent.select(F.col(parent_key).alias(child_key)).distinct()
    return child.filter(F.col(child_key).isNotNull()).join(parents, child_key, "left_anti")


def audit_not_null(df: DataFrame, columns: list[str]) -> DataFrame:
    """``(column_name, null_rows)``, all columns counted in one pass."""
    counts = df.agg(*[F.count_if(F.col(name).isNull()).alias(name) for name in columns])
    rows = [
        F.struct(F.lit(name).alias("column_name"), F.col(name).alias("null_rows")) for name in columns
    ]
    return counts.select(F.inline(F.array(*rows)))


UNIQUE = {
    "websites.url unique": ("websites", ["url"]), "keywords.word unique": ("keywords", ["word"]),
    "postings unique": ("postings", ["word", "url"]), "links unique": ("links", ["source_url", "target_website"]),
}
KNOWN = {
    "postings.word known": ("postings", "word", "keywords", "word"), "postings.url known": ("postings", "url", "websites", "url"),
    "links.source_url known": ("links", "source_url", "websites", "url"),
}
COLUMNS = {
    "websites": ["url", "title", "description", "word_count"], "keywords": ["word", "documents_containing_word"],
    "postings": ["word", "url", "keyword_occurrences"], "links": ["source_url", "target_website"],
}


def unknown_rows(child: DataFrame, parents: list[DataFrame], key: str, parent_key: str) -> DataFrame:
    """``violations``: rows of a child whose key no parent has. Rows are counted by key before they meet the
    parents, so a key of very many rows is one row per task; NULL keys pass."""
    counted = child.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    for parent in parents:
        counted = counted.join(parent.select(F.col(parent_key).alias(key)), key, "left_anti")
    return counted.agg(F.coalesce(F.sum("_rows"), F.lit(0)).alias("violations"))


def _checks(tables: dict[str, DataFrame], earlier: dict[str, DataFrame], parents: dict[str, list[DataFrame]]) -> DataFrame:
    """Violations in some tables: keys that they repeat or that are ``earlier`` there, rows that no parent knows, and nulls."""
    counted = []
    for name, (table, keys) in UNIQUE.items():
        groups = tables[table].groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
        if table in earlier:
            seen = earlier[table].groupBy(*keys).agg(F.count(F.lit(1)).alias("_seen"))
            groups = groups.join(seen, keys, "left").withColumn("n", F.col("n") + F.coalesce("_seen", F.lit(0))).filter(
                F.coalesce("_seen", F.lit(0)) <= 1  # a key that was there twice is counted already
            )
        counted.append(groups.agg(F.count_if(F.col("n") > 1).alias("violations")).select(F.lit(name).alias("check"), "violations"))
    for name, (child, key, parent, parent_key) in KNOWN.items():
        counted.append(unknown_rows(tables[child], parents[parent], key, parent_key).select(F.lit(name).alias("check"), "violations"))
    for name, columns in COLUMNS.items():
        check = F.concat(F.lit(name + "."), "column_name", F.lit(" not null")).alias("check")
        counted.append(audit_not_null(tables[name], columns).select(check, F.col("null_rows").alias("violations")))
    return reduce(DataFrame.unionByName, counted)


def audit_index(websites: DataFrame, keywords: DataFrame, postings: DataFrame, links: DataFrame) -> DataFrame:
    """``(check, violations)`` for every constraint of the four tables."""
    tables = {"websites": websites, "keywords": keywords, "postings": postings, "links": links}
    return _checks(tables, {}, {name: [tables[name]] for name in ("keywords", "websites")})


def audit_delta(
    batch: dict[str, DataFrame], stored: dict[str, DataFrame], pages_repeat: bool, later_words: DataFrame | None = None
) -> DataFrame:
    """Violations that a batch adds to what ``audit_index`` finds in the stored tables before it.

    Rows of the batch are compared with each other, and with stored ones only where that can matter: URLs and words
    with the stored lists of these. As a posting or link is kept with its page, it can repeat a stored one only if a
    page does, which ``pages_repeat`` says; only then the stored postings and links are read. ``later_words``: keywords that
    were added since, if the batch is not the last.
    """
    earlier = {name: stored[name] for name in (("websites", "keywords", "postings", "links") if pages_repeat else ("websites", "keywords"))}
    parents = {name: [batch[name], stored[name]] for name in ("keywords", "websites")}
    if later_words is not None:
        parents["keywords"].append(later_words)
    return _checks(batch, earlier, parents)
