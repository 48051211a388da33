"""Language labels from trigram weights that Spark learns from labelled text."""

from __future__ import annotations

from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webloom.functions.trigrams import BUCKETS, best_languages, slices, trigram_buckets

WEIGHT_SCALE = 1000
MAX_LANGUAGES = 256


@dataclass(frozen=True)
class LanguageModel:
    """``weights[language, bucket]``: whole numbers, as floats for fast products
    that stay exact."""

    languages: list[str]
    weights: np.ndarray


def trigram_counts(labelled: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """``(lang, bucket, n)``. Each Arrow batch is summed before the shuffle, so a
    language with most of the text sends no more rows than any other."""

    def count(batches):
        for batch in batches:
            totals: dict[str, np.ndarray] = {}
            for label, value in chain.from_iterable(slices(batch.column(0), batch.column(1))):
                if label is not None and value:
                    sums = totals.setdefault(label, np.zeros(BUCKETS, np.int64))
                    sums += np.bincount(trigram_buckets(value), minlength=BUCKETS)
            for label, sums in totals.items():
                seen = np.flatnonzero(sums)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([label] * len(seen)), pa.array(seen.astype(np.int32)), pa.array(sums[seen])],
                    ["lang", "bucket", "n"],
                )

    counted = labelled.select(F.col(lang), F.col(text)).mapInArrow(count, "lang string, bucket int, n long")
    return counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def language_weights(counts: DataFrame) -> DataFrame:
    """``(lang, bucket, weight)``: smoothed log share of each bucket, scaled to an
    integer so that sums are exact. Bucket -1 holds the weight of unseen ones. The counts are worked out once: a language
    is one row of at most ``BUCKETS`` of them."""
    unseen = F.array(F.struct(F.lit(-1).alias("bucket"), F.lit(0).cast("long").alias("n")))
    found = F.collect_list(F.struct(F.col("bucket").cast("int").alias("bucket"), F.col("n").cast("long").alias("n")))
    languages = counts.groupBy("lang").agg(F.sum("n").alias("total"), found.alias("found"))
    known = F.when(F.col("lang").isNotNull(), F.concat(unseen, "found")).otherwise(unseen)
    share = (F.col("n") + 1.0) / (F.col("total") + float(BUCKETS))
    weight = F.round(F.lit(float(WEIGHT_SCALE)) * F.log(share)).cast("long")
    return languages.select("lang", "total", F.inline(known)).select("lang", "bucket", weight.alias("weight"))


def load_language_model(weights: DataFrame) -> LanguageModel:
    """Dense matrix on the driver: (languages x 4,096) values whatever the corpus size."""
    if weights.filter("bucket = -1").limit(MAX_LANGUAGES + 1).count() > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages in the training labels")
    rows = weights.collect()
    languages = sorted({row["lang"] for row in rows})
    index = {lang: at for at, lang in enumerate(languages)}
    matrix = np.empty((len(languages), BUCKETS))
    for row in rows:
        if row["bucket"] < 0:
            matrix[index[row["lang"]], :] = row["weight"]
    for row in rows:
        if row["bucket"] >= 0:
            matrix[index[row["lang"]], row["bucket"]] = row["weight"]
    return LanguageModel(languages, matrix)


def train_language_model(labelled: DataFrame, text: str = "text", lang: str = "lang") -> LanguageModel:
    return load_language_model(language_weights(trigram_counts(labelled, text, lang)))


def detect_language(text: Column, model: LanguageModel) -> Column:
    """Language of a text column, NULL for empty text; no shuffle, one Arrow pass."""

    @F.arrow_udf("string")
    def label(texts: pa.Array) -> pa.Array:
        labels = chain.from_iterable(best_languages(some, model) for some in slices(texts))
        return pa.array(list(labels), pa.string())

    return label(text)
