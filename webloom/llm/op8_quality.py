"""Quality classifier learned from trusted positives and unlabelled text.

Features describe how a text is written: letter case, marks, repetition, vocabulary, lines
and lengths; each is cut into bins at quantiles of the unlabelled text, so a linear
function of them can take any shape per feature. The class prior is estimated first: a
plain classifier of trusted against unlabelled orders the texts, and the least ratio of
unlabelled to trusted mass over its upper parts bounds the share of positives. The model
then minimises the non-negative unbiased risk: the risk of positives plus that of the
unlabelled text less the positives in it, the latter never let below zero.

Learning uses at most ``TRUSTED`` positives and ``UNLABELLED`` other texts, those of least
id hash: a bounded sample; negative labels are not used. Scoring is one scan of all whole
texts without a shuffle, with a model of a few hundred numbers.

Null and empty texts are scored as texts without words. Labels that are null or repeat are
left out or count once. Without positives the score is 0.5 for all. Repeated rows get
equal scores. Other columns, whatever their names, are kept by ``score``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from webloom.llm.op1_toxicity import held_out
from webloom.llm.words import NOT_BLANK, Words, text_slices

TRUSTED, UNLABELLED = 8000, 16000
BINS = 12
ROUNDS, RATE, WEIGHT_DECAY = 400, 0.05, 3e-4
LEAST_SHARE = 0.05  # of the trusted texts, in a part that bounds the prior
THRESHOLD = 0.5
SCORE = "_quality"
_MARKS = ("!", "*#%&$@^~", "|", "<>{}[]=_\\", ".?", ",;:", "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")
NAMES = (
    "exclamation", "symbols", "pipes", "brackets", "stops", "commas", "digits", "capitals", "beyond_ascii", "lines",
    "word_length", "log_words", "same_as_last", "same_as_second_last", "distinct", "longest_word",
)


def _tables() -> np.ndarray:
    tables = np.zeros((len(_MARKS) + 1, 256))
    for i, marks in enumerate(_MARKS):
        tables[i, [ord(m) for m in marks]] = 1
    tables[len(_MARKS), 0x80:] = 1
    return tables


def features(column: pa.Array) -> np.ndarray:
    """One row of raw features for each text."""
    tables, out = _tables(), []
    for _, n, data, offsets in text_slices(column):
        words = Words(data, offsets, NOT_BLANK)
        hashes = words.hashes()
        counts = np.maximum(words.counts, 1)
        sizes = np.maximum(np.diff(offsets), 1)

        def per_text(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
            total = np.zeros(len(values) + 1)
            np.cumsum(values, out=total[1:])
            return total[ends[1:]] - total[ends[:-1]]

        marks = [per_text(t[data], offsets) for t in tables]
        found = [m / counts for m in marks[:7]] + [marks[7] / sizes, marks[8] / sizes]
        found.append(per_text((data == 10).astype(float), offsets) / counts)
        lengths = (words.ends - words.starts).astype(float)
        found.append(per_text(lengths, words.firsts) / counts)
        found.append(np.log1p(words.counts))
        for back in (1, 2):
            same = np.zeros(len(hashes))
            same[back:] = (hashes[back:] == hashes[:-back]) & (words.rows[back:] == words.rows[:-back])
            found.append(per_text(same, words.firsts) / counts)
        order = np.lexsort((hashes, words.rows))
        new = np.ones(len(hashes))
        if len(hashes):
            h, r = hashes[order], words.rows[order]
            new[1:] = (h[1:] != h[:-1]) | (r[1:] != r[:-1])
        # the share of distinct words falls with length: compare with what is usual for it
        found.append(np.log1p(per_text(new, words.firsts)) / np.maximum(np.log1p(words.counts), 0.5))
        longest = np.zeros(n)
        np.maximum.at(longest, words.rows, lengths)
        found.append(longest)
        out.append(np.stack(found, axis=1))
    return np.concatenate(out) if out else np.zeros((0, len(NAMES)))


@dataclass
class Model:
    cuts: np.ndarray  # features x (bins - 1)
    weights: np.ndarray
    intercept: float
    prior: float

    def values(self, raw: np.ndarray) -> np.ndarray:
        return self.intercept + binned(raw, self.cuts) @ self.weights

    def scores(self, raw: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.values(raw), -30, 30)))


def quantile_cuts(raw: np.ndarray) -> np.ndarray:
    return np.quantile(raw, np.linspace(0, 1, BINS + 1)[1:-1], axis=0).T


def binned(raw: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """For each feature, whether it is over each cut."""
    return np.concatenate([raw[:, [i]] > cuts[i][None, :] for i in range(raw.shape[1])], axis=1).astype(np.float64)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class _Descent:
    """Steps of Adam."""

    def __init__(self, n: int):
        self.w, self.m, self.v, self.t = np.zeros(n), np.zeros(n), np.zeros(n), 0

    def step(self, slope: np.ndarray) -> None:
        self.t += 1
        self.m = 0.9 * self.m + 0.1 * slope
        self.v = 0.999 * self.v + 0.001 * slope**2
        self.w -= RATE * (self.m / (1 - 0.9**self.t)) / (np.sqrt(self.v / (1 - 0.999**self.t)) + 1e-8)


def _with_one(x: np.ndarray) -> np.ndarray:
    return np.c_[x, np.ones(len(x))]


def _decay(trusted: int) -> float:
    """Small samples need a smoother function."""
    return WEIGHT_DECAY * (1 + 4000 / max(trusted, 1))


def estimate_prior(trusted: np.ndarray, unlabelled: np.ndarray) -> float:
    """Share of positives in the unlabelled text: the least ratio of masses over upper parts of a
    classifier's order. Either half of the texts is ordered by
    the classifier of the other half, as one orders its own texts too well."""
    s, t = [], []
    for half in (0, 1):
        p, u = trusted[half::2], unlabelled[half::2]
        if not len(p) or not len(u):
            continue
        down = _Descent(trusted.shape[1])
        for _ in range(ROUNDS // 2):
            down.step(
                p.T @ (_sigmoid(p @ down.w) - 1) / len(p) + u.T @ _sigmoid(u @ down.w) / len(u)
                + _decay(len(p)) * np.r_[down.w[:-1], 0]
            )
        s.append(trusted[1 - half :: 2] @ down.w)
        t.append(unlabelled[1 - half :: 2] @ down.w)
    if not s or not sum(map(len, s)) or not sum(map(len, t)):
        return 0.5
    s, t = np.sort(np.concatenate(s)), np.sort(np.concatenate(t))
    levels = np.unique(np.quantile(s, np.linspace(0, 1 - LEAST_SHARE, 200)))
    above_p = 1 - np.searchsorted(s, levels) / len(s)
    above_u = 1 - np.searchsorted(t, levels) / len(t)
    return float(np.clip(np.min(above_u / above_p), 0.01, 0.99))


def fit(trusted: np.ndarray, unlabelled: np.ndarray) -> Model:
    """Minimise the non-negative unbiased risk with the logistic loss."""
    cuts = quantile_cuts(np.concatenate([unlabelled, trusted]) if len(unlabelled) else trusted)
    p, u = _with_one(binned(trusted, cuts)), _with_one(binned(unlabelled, cuts))
    prior = estimate_prior(p, u)
    down = _Descent(p.shape[1])
    for _ in range(ROUNDS):
        fp, fu = p @ down.w, u @ down.w
        as_positive = p.T @ (_sigmoid(fp) - 1) / len(p)
        as_negative = u.T @ _sigmoid(fu) / len(u) - prior * (p.T @ _sigmoid(fp)) / len(p)
        risk = np.logaddexp(0, fu).mean() - prior * np.logaddexp(0, fp).mean()
        # where the negatives' risk is below zero the fit is too close: step back on that part
        slope = prior * as_positive + as_negative if risk >= 0 else -as_negative
        down.step(slope + _decay(len(p)) * np.r_[down.w[:-1], 0])
    return Model(cuts, down.w[:-1], float(down.w[-1]), prior)


# --- on Spark ----------------------------------------------------------------------------


def _featured(docs: DataFrame, column: str = "text") -> DataFrame:
    schema = StructType([f for f in docs.schema.fields if f.name != column] + [StructField(n, DoubleType()) for n in NAMES])

    def describe(batches):
        for batch in batches:
            raw = features(batch.column(column))
            kept = [(n, batch.column(n)) for n in batch.schema.names if n != column]
            yield pa.RecordBatch.from_arrays(
                [c for _, c in kept] + [pa.array(raw[:, i]) for i in range(len(NAMES))], [n for n, _ in kept] + list(NAMES)
            )

    return docs.mapInArrow(describe, schema)


def train(docs: DataFrame, labels: DataFrame, label: str = "quality") -> Model | None:
    """Fit on a bounded sample; None without positives."""
    known = labels.filter((F.col(label) == 1) & F.col("doc_id").isNotNull()).select("doc_id").distinct()
    order = (F.xxhash64("doc_id", F.lit(8)), F.col("doc_id"))
    trusted = known.orderBy(*order).limit(TRUSTED).withColumn("trusted", F.lit(1))
    others = docs.select("doc_id").filter(F.col("doc_id").isNotNull()).distinct().orderBy(*order).limit(UNLABELLED)
    sample = trusted.unionAll(others.withColumn("trusted", F.lit(0)))
    rows = _featured(docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")).toPandas()
    rows = rows.sort_values(["trusted", "doc_id", *NAMES])
    raw, kind = rows[list(NAMES)].to_numpy(), rows["trusted"].to_numpy()
    return fit(raw[kind == 1], raw[kind == 0]) if (kind == 1).any() else None


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """``docs`` with the column ``SCORE``, from 0 to 1."""
    if model is None:
        return docs.withColumn(SCORE, F.lit(0.5))
    shared = docs.sparkSession.sparkContext.broadcast((model.cuts, model.weights, model.intercept, model.prior))
    schema = StructType([f for f in docs.schema.fields if f.name != SCORE] + [StructField(SCORE, DoubleType())])

    def scan(batches):
        own = Model(*shared.value)
        for batch in batches:
            kept = [(n, batch.column(n)) for n in batch.schema.names if n != SCORE]
            found = pa.array(own.scores(features(batch.column("text"))))
            yield pa.RecordBatch.from_arrays([c for _, c in kept] + [found], [n for n, _ in kept] + [SCORE])

    return docs.mapInArrow(scan, schema)


def quality_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Score and decision of each document; labels of the held-out third are not used."""
    docs = docs.select("doc_id", "text")
    model = train(docs, labels.filter(~held_out(F.col("doc_id"), 3, 1)))
    return score(docs, model).select(
        "doc_id", held_out(F.col("doc_id"), 3, 1).alias("held_out"), F.col(SCORE).alias("score"),
        (F.col(SCORE) >= THRESHOLD).cast("int").alias("predicted"),
    )
