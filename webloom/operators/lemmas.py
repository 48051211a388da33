"""Lemma dictionary and the lookup of words in it."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webloom.functions.text import UNICODE_BLANKS
from webloom.session import checked_lookup, lookup_join, scratch_dir

# Fixed value: form of a dictionary line, ``lemma/number -> word,word``.
LINE_PATTERN = r"(?d)^([^/]+)[^->]*->(.+)$"
BROADCAST_ROWS = 1_000_000
FREQUENT_BYTES = 64 << 20  # of the frequent words that are broadcast
ROWS_PER_TASK = 1_000_000


def trimmed(text: Column) -> Column:
    """Without white space of any kind at either end."""
    return F.trim(text, F.lit(UNICODE_BLANKS))


def lemma_dictionary(lines: DataFrame) -> DataFrame:
    """``(word, lemma)`` from ``(line, line_pos)``; a later entry for a word wins.

    Lines of another form are skipped and case is kept, so an upper-case entry
    never matches a lower-cased token.
    """
    entries = lines.filter(F.col("line").rlike(LINE_PATTERN)).select(
        "line_pos",
        trimmed(F.regexp_extract("line", LINE_PATTERN, 1)).alias("lemma"),
        F.posexplode(F.split(F.regexp_extract("line", LINE_PATTERN, 2), ",")).alias("pos", "entry"),
    )
    return (
        entries.withColumn("word", trimmed(F.col("entry")))
        .groupBy("word")
        .agg(F.max_by("lemma", F.struct("line_pos", "pos")).alias("lemma"))
    )


def counted_words(rows: DataFrame, dictionary: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Stored ``(word, n)`` of the rows' words, and ``(word, lemma, n)`` of those that the dictionary has. As they are
    stored, all who ask later are told the same words."""
    spark, folder = rows.sparkSession, f"{scratch_dir(rows.sparkSession)}/lemmas-{uuid.uuid4().hex}"
    counted = rows.filter(F.col("word").isNotNull()).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    counted.write.parquet(f"{folder}/counts")
    counts = spark.read.schema("word string, n bigint").parquet(f"{folder}/counts")
    counts.join(dictionary.select("word", "lemma"), "word").select("word", "lemma", "n").write.parquet(f"{folder}/present")
    return counts, spark.read.schema("word string, lemma string, n bigint").parquet(f"{folder}/present")


def frequent_from(counts: DataFrame, most: int) -> int | None:
    """How often a word occurs at least that is one of the ``most`` frequent ones; None if not even the words of the
    highest power of two are so few. How many words there are by power of two of their count tells it."""
    power = F.floor(F.log2(F.col("n").cast("double"))).cast("int").alias("power")
    sizes = counts.groupBy(power).agg(F.count(F.lit(1)).alias("words"), F.sum(F.octet_length("word")).alias("bytes")).collect()
    low, words, size = None, 0, 0
    for r in sorted(sizes, key=lambda r: -r["power"]):
        words, size = words + r["words"], size + r["bytes"]
        if words > most or size > FREQUENT_BYTES:
            break
        low = 1 << r["power"]
    return low


def _with_lemma(rows: DataFrame, dictionary: DataFrame, max_broadcast: int) -> DataFrame:
    """Rows with their ``lemma``, NULL for words without one."""
    lookup = checked_lookup(dictionary.select("word", "lemma"), max_broadcast)
    if lookup.small:
        return lookup_join(rows, lookup, "word")
    counts, present = counted_words(rows, lookup.rows)
    needed = checked_lookup(present.select("word", "lemma"), max_broadcast)
    if needed.small:
        return lookup_join(rows, needed, "word")
    low = frequent_from(counts, max_broadcast)
    frequent = counts.filter(F.col("n") >= (low or 0)).select("word").join(present.select("word", "lemma"), "word", "left")
    if low is None or not checked_lookup(frequent, max_broadcast).small:
        return lookup_join(rows, needed, "word")
    settled = rows.join(F.broadcast(frequent.withColumn("_settled", F.lit(True))), "word", "left")
    settled = settled.filter(F.col("_settled") | F.col("word").isNull()).drop("_settled")
    rare = rows.filter(F.col("word").isNotNull()).join(F.broadcast(frequent.select("word")), "word", "left_anti")
    # a word that is left occurs less than ``low`` times, so no task gets many rows of one
    rare = rare.join(needed.rows, "word", "left") if low <= ROWS_PER_TASK else lookup_join(rare, needed, "word", ROWS_PER_TASK)
    return settled.unionByName(rare)


def lemmatise_rows(rows: DataFrame, dictionary: DataFrame, max_broadcast: int = BROADCAST_ROWS) -> DataFrame:
    """Replace ``word`` by its lemma, or leave it; every row is kept.

    A dictionary of checked size is broadcast. Of a larger one, the entries of words that the rows have are, and if
    these are too many, those of the most frequent words, which most rows have; then only rows of other words shuffle.
    """
    return _with_lemma(rows, dictionary, max_broadcast).withColumn("word", F.coalesce("lemma", "word")).drop("lemma")


def lemmatise(
    pages: DataFrame, words: str, dictionary: DataFrame, keys: list[str], max_broadcast: int = BROADCAST_ROWS
) -> DataFrame:
    """``(keys, pos, word)``: the tokens of each row as lemmas, order and repeats kept."""
    exploded = pages.select(*keys, F.posexplode(words).alias("pos", "word"))
    return lemmatise_rows(exploded, dictionary, max_broadcast).select(*keys, "pos", "word")
