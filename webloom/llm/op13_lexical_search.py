"""Ranked lexical search by pipelined term partitioning.

Every term belongs to one owner, rare terms to the first and frequent ones to the last. Items travel in bundles
through the owners one after the other: at each owner a cogroup brings a bundle's sparse accumulators, the scores so far of the
documents of a slice, together with the owner's postings in that slice, adds the integer contributions, and
sends the bundle on. After the last owner the twenty best of each slice remain, from which the best of all are selected.

An owner sends on only documents that can still be among the twenty best of their slice: those whose score and all
that later owners can add to it reach the twentieth score so far. That bound is exact, from the largest contribution that each term has
anywhere, so no document that belongs to the result is lost. A document left out earlier may come back with
a part of its score, which is then below twenty others.

A slice is a batch of documents as they are read. Its rows are numbered in order of doc_id, so equal scores are settled
alike within a slice and between slices. A document is a row: rows of one doc_id rank each for itself.

Scale: texts are read once, for the postings of the items' terms, which are stored as one row per term and slice. The
terms of the items are given to tasks when they are counted to be at most ``TERMS``; with more, all postings
are written and joined with them. All that follows moves postings and accumulators of a slice and a bundle of at most about ``BUNDLE`` items, however frequent a
term is. Terms are told apart by 64-bit hashes.

A null text has no terms, a null item no result. A null doc_id comes after all others, and a null item_id is an item of its own.
Equal rows of an item are one; rows of one item_id with different texts are one item with the terms of
all. Empty tables give an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from webloom.llm.storage import BROADCAST_ROWS, join_checked, stored
from webloom.llm.words import ALNUM, Words, text_slices

BEST = 20
OWNERS = 4
BUNDLE = 256  # items
TERMS = 500_000  # hashes given to tasks, 4 MB
NO_ITEM = -(1 << 63)  # stands for a null item_id in joins

POSTINGS = "slice bigint, term bigint, at array<int>, tf array<int>, n array<int>, docs array<bigint>"


# --- postings ----------------------------------------------------------------------------------


def _terms(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Per run of rows: row, term and frequency of each distinct pair, and the number of terms of each row."""
    for first, _, data, offsets in text_slices(column):
        words = Words(data, offsets, ALNUM)
        hashes = words.hashes().view(np.int64)
        order = np.lexsort((hashes, words.rows))
        rows, hashes = words.rows[order], hashes[order]
        new = np.ones(len(rows), bool)
        new[1:] = (rows[1:] != rows[:-1]) | (hashes[1:] != hashes[:-1])
        starts = np.flatnonzero(new)
        yield first + rows[starts], hashes[starts], np.diff(np.append(starts, len(rows))), words.counts


def item_terms(items: DataFrame) -> DataFrame:
    """``item, term, times`` of ``item_id, text``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch["item"]
            for rows, hashes, times, _ in _terms(batch["text"]):
                yield pa.record_batch([pc.take(ids, pa.array(rows)), pa.array(hashes), pa.array(times)], ["item", "term", "times"])

    rows = items.select(F.coalesce(F.col("item_id").cast("bigint"), F.lit(NO_ITEM)).alias("item"), "text").distinct()
    found = rows.mapInArrow(run, "item bigint, term bigint, times bigint")
    return found.groupBy("item", "term").agg(F.sum("times").alias("times"))


def _lists(values: np.ndarray, starts: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.append(starts, len(values)), pa.int32()), pa.array(values, kind))


def postings(docs: DataFrame, wanted=None) -> DataFrame:
    """A row per slice and term: places ``at`` in the slice, frequencies ``tf`` and document lengths ``n``, and a row
    per slice without a term: ids ``docs`` and lengths ``n`` of all. ``wanted``: broadcast sorted hashes, all if None."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [field.split()[0] for field in POSTINGS.split(", ")]
        for number, batch in enumerate(b for b in batches if b.num_rows):
            slice_id = (TaskContext.get().partitionId() << 32) + number
            batch = batch.take(pc.sort_indices(batch["doc_id"], null_placement="at_end"))
            rows, hashes, tf, counts = (np.concatenate(x) for x in zip(*_terms(batch["text"])))
            if wanted is not None:
                keys = wanted.value
                near = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
                keep = keys[near] == hashes
                rows, hashes, tf = rows[keep], hashes[keep], tf[keep]
            order = np.argsort(hashes, kind="stable")  # rows stay in order within a term
            rows, hashes, tf = rows[order], hashes[order], tf[order]
            starts = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1])) if len(hashes) else np.zeros(0, int)
            empty = pa.nulls(1, pa.list_(pa.int32()))
            yield pa.record_batch(
                [
                    pa.array(np.full(len(starts), slice_id)), pa.array(hashes[starts], pa.int64()), _lists(rows, starts, pa.int32()),
                    _lists(tf, starts, pa.int32()), _lists(counts[rows], starts, pa.int32()),
                    pa.nulls(len(starts), pa.list_(pa.int64())),
                ],
                names,
            )
            yield pa.record_batch(
                [
                    pa.array([slice_id]), pa.nulls(1, pa.int64()), empty, empty,
                    _lists(counts, np.zeros(1, int), pa.int32()), pa.array([batch["doc_id"].to_pylist()], pa.list_(pa.int64())),
                ],
                names,
            )

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, POSTINGS)


# --- owners --------------------------------------------------------------------------------------


def _weighted(rows: DataFrame, documents: int, length: int) -> DataFrame:
    """Postings with contributions of weight 1 in place of frequencies and lengths."""
    impact = F.expr(
        f"zip_with(tf, n, (t, n) -> (1000000000L * t) div (1000L * t + 12L * (75L + (25L * n * {documents}L) div {length}L)))"
    )
    return rows.select("slice", "term", "at", impact.alias("impact"))


def _owned_terms(parts: DataFrame, documents: int) -> DataFrame:
    """``term, weight, owner, most``: owners by weight, and the largest contribution of each term."""
    terms = parts.groupBy("term").agg(F.sum(F.size("at")).alias("df"), F.max(F.array_max("impact")).alias("most"))
    weight = F.floor(1000 * F.log((2.0 * documents + 2) / (2 * F.col("df") + 1))).cast("bigint")
    terms = stored(terms.select("term", weight.alias("weight"), (weight * F.col("most")).alias("most")))
    largest = terms.agg(F.max("weight")).first()[0] or 0
    owner = F.floor((largest - F.col("weight")) * OWNERS / F.lit(largest + 1)).cast("int")
    return terms.withColumn("owner", owner)


def _stage(best: int):
    """Adds an owner's contributions to the accumulators of a bundle in a slice."""

    def run(bundle: pa.Table, own: pa.Table) -> pa.Table:
        scores, rest, key = {}, {}, None
        places = [c for t in (bundle, own) for c in t["at"].chunks if len(c)]
        size = 1 + max((pc.max(c.flatten()).as_py() for c in places), default=-1)
        for table in (bundle, own):
            if len(table):
                key = table["slice"][0].as_py(), table["bundle"][0].as_py()
        for item, left, at, score in zip(*(bundle[c] for c in ("item", "rest", "at", "score"))):
            total = scores[item.as_py()] = np.zeros(size, np.int64)
            total[at.values.to_numpy()] = score.values.to_numpy()
            rest[item.as_py()] = left.as_py()
        for at, impact, weight, items in zip(*(own[c] for c in ("at", "impact", "weight", "items"))):
            at, worth = at.values.to_numpy(), impact.values.to_numpy() * weight.as_py()
            for x in items.as_py():
                total = scores.setdefault(x["item"], np.zeros(0, np.int64))
                if not len(total):
                    total = scores[x["item"]] = np.zeros(size, np.int64)
                total[at] += worth * x["times"]
                rest[x["item"]] = x["rest"]
        out = []
        for item, total in scores.items():
            at = np.flatnonzero(total)
            if len(at) > best:
                reached = np.partition(total[at], -best)[-best]
                at = at[total[at] + rest[item] >= reached]
                if not rest[item]:  # equal scores: the smaller place is the smaller doc_id
                    at = at[np.lexsort((at, -total[at]))[:best]]
            if len(at):
                out.append((*key, item, rest[item], at.astype(np.int32), total[at]))
        columns = list(zip(*out)) or [[]] * 6
        return pa.table({
            name: pa.array(list(column), kind)
            for name, column, kind in zip(
                ("slice", "bundle", "item", "rest", "at", "score"), columns,
                (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64())),
            )
        })

    return run


ACCUMULATORS = "slice bigint, bundle bigint, item bigint, rest bigint, at array<int>, score array<bigint>"


def search(docs: DataFrame, items: DataFrame, best: int = BEST, most_terms: int = TERMS, bundle: int = BUNDLE) -> DataFrame:
    """``item_id, rank, doc_id, score`` of the ``best`` documents of each item."""
    spark = docs.sparkSession
    queries = stored(item_terms(items))
    terms = queries.select("term").distinct()
    n_terms, n_items = terms.count(), queries.select("item").distinct().count()
    if n_terms <= most_terms:  # counted: at most 8 bytes each
        hashes = np.sort(np.array([r[0] for r in terms.collect()], np.int64))
        wanted = spark.sparkContext.broadcast(hashes if n_terms else np.zeros(1, np.int64))
        found = stored(postings(docs, wanted))
        wanted.destroy()
    else:
        found = stored(postings(docs))
    slices = found.filter("term IS NULL").select("slice", "docs", "n")
    documents, length = slices.agg(
        F.sum(F.size(F.filter("n", lambda x: x > 0))),
        F.sum(F.aggregate("n", F.lit(0).cast("bigint"), lambda s, x: s + x)),
    ).first()
    empty = "item_id bigint, rank int, doc_id bigint, score bigint"
    if not length or not n_terms:
        return spark.createDataFrame([], empty)
    parts = found.filter("term IS NOT NULL")
    if n_terms > most_terms:
        parts = parts.join(terms, "term", "left_semi")
    parts = stored(_weighted(parts, documents, length))
    owned = stored(_owned_terms(parts, documents))

    # what later owners can add to an item's scores, after each owner
    items_owned = stored(join_checked(queries, owned, ["term"]))
    later = items_owned.groupBy("item", "owner").agg(F.sum(F.col("times") * F.col("most")).alias("adds"))
    after = W.partitionBy("item").orderBy(F.col("owner").desc()).rowsBetween(W.unboundedPreceding, -1)
    later = later.select("item", "owner", F.coalesce(F.sum("adds").over(after), F.lit(0)).alias("rest"))
    bundles = -(-n_items // bundle)
    needs = items_owned.join(later, ["item", "owner"]).select(
        "term", "owner", "weight", F.pmod(F.xxhash64("item"), F.lit(bundles)).alias("bundle"), F.struct("item", "times", "rest").alias("x")
    )
    needs = stored(needs.groupBy("term", "owner", "weight", "bundle").agg(F.collect_list("x").alias("items")))
    dealt = join_checked(parts, needs.filter("weight > 0"), ["term"], most=BROADCAST_ROWS // 10)

    moving = spark.createDataFrame([], ACCUMULATORS)
    for owner in range(OWNERS):
        own = dealt.filter(F.col("owner") == owner).select("slice", "bundle", "weight", "items", "at", "impact")
        moving = moving.groupBy("slice", "bundle").cogroup(own.groupBy("slice", "bundle")).applyInArrow(_stage(best), ACCUMULATORS)

    # accumulators whose last owner had nothing for them may be more than the best of their slice
    found = moving.select("slice", "item", F.explode(F.arrays_zip("at", "score")).alias("x")).select("slice", "item", "x.at", "x.score")
    in_slice = W.partitionBy("slice", "item").orderBy(F.desc("score"), "at")
    found = found.withColumn("place", F.row_number().over(in_slice)).filter(F.col("place") <= best)
    named = found.join(slices.select("slice", "docs"), "slice").select(
        "item", F.get("docs", F.col("at")).alias("doc_id"), "score"
    )
    rank = F.row_number().over(W.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last()))
    return named.withColumn("rank", rank).filter(F.col("rank") <= best).select(
        F.nullif("item", F.lit(NO_ITEM)).alias("item_id"), "rank", "doc_id", "score"
    )


SQL = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM documents),
totals AS (SELECT count(*) FILTER (len(words) > 0) AS docs, CAST(sum(len(words)) AS BIGINT) AS length FROM d),
i AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS term
    FROM (SELECT DISTINCT item_id, text FROM benchmark)) GROUP BY item_id, term),
p AS (SELECT r, doc_id, len_words, term, count(*) AS tf FROM (SELECT r, doc_id, len(words) AS len_words, unnest(words) AS term FROM d)
    WHERE term IN (SELECT term FROM i) GROUP BY r, doc_id, len_words, term),
w AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS weight
    FROM (SELECT term, count(*) AS df FROM p GROUP BY term), totals),
s AS (SELECT i.item_id, p.r, p.doc_id, CAST(sum(i.times * w.weight * ((1000000000 * p.tf)
    // (1000 * p.tf + 12 * (75 + (25 * p.len_words * docs) // length)))) AS BIGINT) AS score
    FROM i JOIN p USING (term) JOIN w USING (term), totals GROUP BY i.item_id, p.r, p.doc_id)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM s WHERE score > 0 QUALIFY rank <= 20
"""
