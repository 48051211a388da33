"""Removal of repeated byte strings by partitioned sorting of suffixes.

A byte is removed if a string of ``LENGTH`` bytes that covers it also starts earlier, in a
smaller document or sooner in the same one. All suffixes of all texts would be far more than the
texts themselves, so they are thinned first, exactly:

1. Each window of ``LENGTH`` bytes has an anchor, the k-gram of least hash within it, which
   depends on the window's bytes alone. Neighbouring windows of one anchor are a run. Runs
   meet by anchor hash; equal runs are repeats of the first of them, and runs that alone
   hold an anchor hold no repeat. Runs repeated within one batch are settled before they move.
2. What is left are runs that share an anchor and differ somewhere. They are cut into blocks
   of ``BLOCK`` windows, which meet by the bytes that all windows of the block have in common.
3. Only for blocks that still meet others, every suffix is made a row: its leading bytes, the
   hash of its ``LENGTH`` bytes, and its place. Sampled splitters range-partition the rows by
   leading bytes, each bucket is sorted by these and, among equal ones, by the hash, so equal strings stand
   together, a row equal to its neighbour's string is a repeat, and the first strings of a bucket are compared with the last ones
   of the bucket before. Places are part of the partitioning key, so a string that a third of
   all documents hold is spread over many buckets.

On the given tables (0.01) the first step finds 92 % of the repeated windows, the second 6 % and the suffixes 2 %. The strings
themselves are not carried through the sort, as that would move six times as much.

Hashes are of 64 bits beside equal leading bytes or anchors. Sorts and joins are Spark's,
memory is bounded by an Arrow batch or a bucket of ``BUCKET_ROWS``.

Null and empty texts have no bytes. Rows of one doc_id are one document in the order of
places, so equal rows do not remove each other; documents without an id come last, as one.
Other columns of the table are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from webloom.llm.storage import join_checked, stored
from webloom.llm.words import U64, _power_table, mix, text_slices

LENGTH = 100
GRAM = 32
BLOCK = 12
BUCKET_ROWS = 400_000
BROADCAST_ITEMS = 4_000_000  # longs in a table of lists that is broadcast
LAST = (1 << 63) - 1

_RUN = "key bigint, content bigint, doc bigint, at bigint, tie bigint"


class Hasher:
    """Hashes of all substrings of a buffer."""

    def __init__(self, data: np.ndarray):
        self.up, self.down = _power_table(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, U64)
        np.cumsum((data.astype(U64) + U64(1)) * self.up[: len(data)], out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.down[starts] + (ends - starts).astype(U64))


def anchors(data: np.ndarray, offsets: np.ndarray, hasher: Hasher) -> tuple[np.ndarray, ...]:
    """Runs of windows with one anchor: first start, number of windows, anchor, anchor hash, row."""
    n = len(data) - LENGTH + 1
    if n <= 0:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, U64, np.int64))
    at = np.arange(len(data) - GRAM + 1)
    grams = hasher.of(at, at + GRAM)
    span, wide = 1, LENGTH - GRAM + 1
    value, place = grams, at.astype(np.int32)
    while span * 2 <= wide:  # leftmost least of 2, 4, 8, ... positions
        right = value[span:] < value[:-span]
        value, place = np.where(right, value[span:], value[:-span]), np.where(right, place[span:], place[:-span])
        span *= 2
    rest = wide - span
    right = value[rest : rest + n] < value[:n]
    place = np.where(right, place[rest : rest + n], place[:n])
    rows = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    starts = np.flatnonzero(rows[:n] == rows[LENGTH - 1 : LENGTH - 1 + n])
    if not len(starts):
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, U64, np.int64))
    anchor = place[starts].astype(np.int64)
    head = np.ones(len(starts), bool)
    head[1:] = (anchor[1:] != anchor[:-1]) | (starts[1:] != starts[:-1] + 1)
    heads = np.flatnonzero(head)
    first = starts[heads]
    return first, np.diff(np.r_[heads, len(starts)]), anchor[heads], grams[anchor[heads]], rows[first]


def _batch(columns: dict[str, np.ndarray | pa.Array]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c.view(np.int64) if c.dtype == U64 else c) for c in columns.values()],
        list(columns),
    )


def _long(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False).astype(np.int64, copy=False)


def _ties(batch: pa.RecordBatch, first: int, n: int, hasher: Hasher, offsets: np.ndarray) -> np.ndarray:
    """Tells rows of one doc_id apart by their text; 0 for all others."""
    repeats = batch.column("repeats").slice(first, n).to_numpy(zero_copy_only=False).astype(bool)
    return np.where(repeats, hasher.of(offsets[:-1], offsets[1:]).view(np.int64), 0)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        parts = []
        docs = _long(batch, "doc")
        for first, n, data, offsets in text_slices(batch.column("text")):
            hasher = Hasher(data)
            start, count, anchor, key, row = anchors(data, offsets, hasher)
            end = start + count + LENGTH - 1
            content = mix(hasher.of(start, end) + mix((anchor - start).astype(U64) * U64(1 << 32) + count.astype(U64)))
            tie = _ties(batch, first, n, hasher, offsets)
            parts.append((key.view(np.int64), content.view(np.int64), docs[first + row], (start - offsets[row]) << 20 | count, tie[row]))
        if parts:
            key, content, doc, at, tie = (np.concatenate(p) for p in zip(*parts, strict=True))
            # settle repeats within the batch: only the first of equal runs need meet others
            order = np.lexsort((at, doc, content, key))
            key, content, doc, at, tie = key[order], content[order], doc[order], at[order], tie[order]
            again = np.zeros(len(key), bool)
            again[1:] = (key[1:] == key[:-1]) & (content[1:] == content[:-1])
            lead = np.maximum.accumulate(np.where(again, 0, np.arange(len(key))))
            again &= (doc != doc[lead]) | (at != at[lead])
            # settled rows travel with a spread key and are told by a content of 0
            key = np.where(again, mix(key.view(U64) + np.arange(len(key)).astype(U64)).view(np.int64), key)
            yield _batch({"key": key, "content": np.where(again, 0, content | 1), "doc": doc, "at": at, "tie": tie})


_CLASSES = "doc bigint, at bigint, tie bigint, repeat boolean"


def _classes(batches: Iterator[pa.RecordBatch], carried: str | None = None) -> Iterator[pa.RecordBatch]:
    """From rows sorted by key, content and place: repeats of equal contents, and the firsts of each
    content that shares its key with others. What one batch leaves open is one row."""
    held = None  # (row of the last content, whether it was put out, whether its key has others)
    names = ("key", "content", "doc", "at", "tie")
    for batch in batches:
        rows = [_long(batch, c) for c in names]
        load = batch.column(carried) if carried else None
        if held:
            rows = [np.r_[h, r] for h, r in zip(held[0], rows, strict=True)]
            load = pa.concat_arrays([held[3], load]) if carried else None
        key, content, doc, at, tie = rows
        n = len(key)
        if not n:
            continue
        new_key = np.ones(n, bool)
        new_key[1:] = key[1:] != key[:-1]
        new = new_key.copy()
        new[1:] |= content[1:] != content[:-1]
        settled = content == 0
        new |= settled
        lead = np.maximum.accumulate(np.where(new, np.arange(n), 0))
        repeat = ~new & ((doc != doc[lead]) | (at != at[lead])) | settled
        group = np.cumsum(new_key) - 1
        kinds = np.bincount(group, weights=new & ~settled)
        several = kinds > 1
        if held:
            several[0] |= held[2]
            repeat[0] = False
        first = new & ~settled & several[group]
        # rows equal in place to the first of their content go where it goes
        first |= ~new & ~repeat & several[group]
        if held and held[1]:
            first[0] = False
        open_group = group == group[-1]
        last = int(lead[-1])
        held = (
            [r[last : last + 1] for r in rows], bool(several[-1]) or bool(settled[last]), bool(several[-1]),
            load.slice(last, 1) if carried else None,
        )
        if not several[-1]:
            first &= ~open_group
        out = np.flatnonzero(repeat | first)
        found = {"doc": doc[out], "at": at[out], "tie": tie[out], "repeat": pa.array(repeat[out])}
        if carried:
            found[carried] = load.take(pa.array(out))
        yield _batch(found)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of windows of the runs in ``runs`` (start << 20 | windows) of each text."""
    for batch in batches:
        docs = _long(batch, "doc")
        lists = batch.column("runs")
        for first, n, data, offsets in text_slices(batch.column("text")):
            hasher = Hasher(data)
            own = lists.slice(first, n)
            row = np.repeat(np.arange(n), own.value_lengths().fill_null(0).to_numpy())
            packed = own.flatten().to_numpy()
            if not len(packed):
                continue
            start, count = (packed >> 20) + offsets[row], packed & 0xFFFFF
            anchor = _anchor_of(hasher, start)
            most, least = anchor - start, anchor - start - count + 1  # offsets of the anchor in its windows
            blocks = most // BLOCK - least // BLOCK + 1
            run = np.repeat(np.arange(len(start)), blocks)
            block = least[run] // BLOCK + np.arange(len(run)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
            low = np.maximum(least[run], block * BLOCK)
            high = np.minimum(most[run], block * BLOCK + BLOCK - 1)
            a = anchor[run]
            core = a - block * BLOCK
            key = mix(hasher.of(core, core + LENGTH - BLOCK + 1) + block.astype(U64))
            begin, end = a - high, a - low + LENGTH
            content = mix(hasher.of(begin, end) + mix((low * BLOCK * LENGTH + high).astype(U64)))
            ends = np.r_[0, np.cumsum(end - begin)]
            bytes_at = np.repeat(begin - ends[:-1], end - begin) + np.arange(ends[-1])
            texts = pa.Array.from_buffers(
                pa.binary(), len(begin), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(data[bytes_at])]
            )
            tie = _ties(batch, first, n, hasher, offsets)
            where = row[run]
            yield _batch({
                "key": key, "content": (content | U64(1)), "doc": docs[first + where],
                "at": (begin - offsets[where]) << 20 | (end - begin - LENGTH + 1), "tie": tie[where], "bytes": texts,
            })


def _anchor_of(hasher: Hasher, start: np.ndarray) -> np.ndarray:
    """Anchor of the window at each start."""
    best, place = None, np.zeros(len(start), np.int64)
    for j in range(LENGTH - GRAM + 1):
        grams = hasher.of(start + j, start + j + GRAM)
        if best is None:
            best = grams
            continue
        lower = grams < best
        best = np.where(lower, grams, best)
        place = np.where(lower, j, place)
    return start + place


def _suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each window of each block: leading bytes, hash of the whole, place."""
    for batch in batches:
        at, doc, tie = (_long(batch, c) for c in ("at", "doc", "tie"))
        count = at & 0xFFFFF
        texts = batch.column("bytes")
        offsets = np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1, texts.offset * 4).astype(np.int64)
        data = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
        offsets = offsets - offsets[0]
        row = np.repeat(np.arange(len(at)), count)
        step = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
        start = offsets[row] + step
        lead = np.zeros(len(row), U64)
        for j in range(8):
            lead = lead << U64(8) | data[start + j].astype(U64)
        whole = Hasher(data).of(start, start + LENGTH)
        yield _batch({
            "lead": (lead >> U64(1)).view(np.int64), "whole": whole, "doc": doc[row], "at": (at[row] >> 20) + step, "tie": tie[row],
        })


def multikey_order(*keys: np.ndarray) -> np.ndarray:
    """Order of rows by several keys: sort by the first, then only runs of equals by the next."""
    order = np.argsort(keys[0], kind="stable")
    same = np.zeros(len(order), bool)
    same[1:] = keys[0][order][1:] == keys[0][order][:-1]
    for key in keys[1:]:
        tied = same.copy()
        tied[:-1] |= same[1:]
        at = np.flatnonzero(tied)
        if not len(at):
            break
        run = np.cumsum(~same[at])
        inner = np.lexsort((key[order[at]], run))
        order[at] = order[at][inner]
        values = key[order]
        same[1:] &= values[1:] == values[:-1]
    return order


_SORTED = "bucket int, kind int, lead bigint, whole bigint, doc bigint, at bigint, tie bigint"
REPEAT, FIRST, FINAL = 0, 1, 2


def _sort_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repeats within a bucket of suffixes, the firsts of its first string, and its last string."""
    parts = [[_long(b, c) for c in ("lead", "whole", "doc", "at", "tie")] for b in batches if b.num_rows]
    if not parts:
        return
    lead, whole, doc, at, tie = (np.concatenate(p) for p in zip(*parts, strict=True))
    order = multikey_order(lead, whole, doc, at)
    lead, whole, doc, at, tie = lead[order], whole[order], doc[order], at[order], tie[order]
    new = np.ones(len(lead), bool)
    new[1:] = (lead[1:] != lead[:-1]) | (whole[1:] != whole[:-1])
    head = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
    repeat = (doc != doc[head]) | (at != at[head])
    for kind, rows in (
        (REPEAT, np.flatnonzero(repeat)), (FIRST, np.flatnonzero((head == 0) & ~repeat)), (FINAL, np.array([len(lead) - 1])),
    ):
        n = len(rows)
        yield _batch({
            "bucket": pa.array(np.full(n, TaskContext.get().partitionId()), pa.int32()), "kind": pa.array(np.full(n, kind), pa.int32()),
            "lead": lead[rows], "whole": whole[rows], "doc": doc[rows], "at": at[rows], "tie": tie[rows],
        })


# --- on Spark ----------------------------------------------------------------------------


def _lists(rows: DataFrame, value: str, name: str) -> DataFrame:
    return stored(rows.groupBy("doc", "tie").agg(F.collect_list(value).alias(name)))


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Overlapping and touching spans of each document become one."""
    for batch in batches:
        lists = batch.column("spans")
        row = np.repeat(np.arange(len(lists)), lists.value_lengths().fill_null(0).to_numpy())
        packed = lists.flatten().to_numpy()
        order = np.lexsort((packed, row))
        row, start, end = row[order], packed[order] >> 32, packed[order] & 0xFFFFFFFF
        reach = np.maximum.accumulate(end + (row << 33)) - (row << 33)  # furthest end so far in the row
        new = np.ones(len(row), bool)
        new[1:] = (row[1:] != row[:-1]) | (start[1:] > reach[:-1])
        heads = np.flatnonzero(new)
        tails = np.r_[heads[1:], len(row)] - 1
        merged = (start[heads] << 32) | reach[tails]
        counts = np.bincount(row[heads], minlength=len(lists))
        spans = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(counts)].astype(np.int32)), pa.array(merged))
        yield pa.RecordBatch.from_arrays([batch.column("doc"), batch.column("tie"), spans], ["doc", "tie", "spans"])


def _with_lists(docs: DataFrame, lists: DataFrame, name: str, how: str) -> DataFrame:
    """Join documents with their lists, broadcast if all their items are few."""
    count = lists.agg(F.count(F.lit(1)) * 4 + F.coalesce(F.sum(F.size(name)), F.lit(0))).first()[0]
    return docs.join(F.broadcast(lists) if count <= BROADCAST_ITEMS else lists, ["doc", "tie"], how)


def _keyed(docs: DataFrame) -> DataFrame:
    """Documents with ``doc`` (nulls last), whether the id repeats, and ``tie``."""
    repeated = stored(docs.groupBy("doc_id").count().filter("count > 1").select(F.coalesce("doc_id", F.lit(LAST)).alias("doc"), F.lit(True).alias("repeats")))
    keyed = docs.withColumn("doc", F.coalesce("doc_id", F.lit(LAST)))
    return join_checked(keyed, repeated, ["doc"], "left").select(
        "doc_id", "text", "doc", F.coalesce("repeats", F.lit(False)).alias("repeats")
    )


def _tied(keyed: DataFrame) -> DataFrame:
    """Add ``tie`` where it is needed, by the same hash as in the scans."""

    def add(batches):
        for batch in batches:
            ties = np.zeros(batch.num_rows, np.int64)
            for first, n, data, offsets in text_slices(batch.column("text")):
                if batch.column("repeats").slice(first, n).true_count:
                    ties[first : first + n] = _ties(batch, first, n, Hasher(data), offsets)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ties)], [*batch.schema.names, "tie"])

    return keyed.mapInArrow(add, "doc_id bigint, text string, doc bigint, repeats boolean, tie bigint")


def _sorted_by_key(rows: DataFrame) -> DataFrame:
    return rows.repartition("key").sortWithinPartitions("key", "content", "doc", "at", "tie")


def _place(at: str = "at") -> F.Column:
    """Bytes covered by the windows of a packed run, as start << 32 | end."""
    start, count = F.shiftright(at, 20), F.col(at).bitwiseAND(0xFFFFF)
    return F.shiftleft(start, 32).bitwiseOR(start + count + F.lit(LENGTH - 1))


def repeated_spans(docs: DataFrame) -> DataFrame:
    """``doc_id, text, spans``: disjoint spans (start << 32 | end, in bytes) whose bytes repeat earlier ones."""
    docs = _keyed(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"))
    tied = _tied(docs)
    runs = docs.select("doc", "repeats", "text").mapInArrow(_runs, _RUN)
    met = stored(_sorted_by_key(runs).mapInArrow(_classes, _CLASSES))

    open_runs = _lists(met.filter(~F.col("repeat")), "at", "runs")
    blocks = _with_lists(tied, open_runs, "runs", "inner").select("doc", "repeats", "text", "runs")
    blocks = blocks.mapInArrow(_blocks, f"{_RUN}, bytes binary")
    met_blocks = stored(
        _sorted_by_key(blocks).mapInArrow(lambda batches: _classes(batches, "bytes"), f"{_CLASSES}, bytes binary")
    )

    suffixes = met_blocks.filter(~F.col("repeat")).select("doc", "at", "tie", "bytes")
    suffixes = stored(suffixes.mapInArrow(_suffixes, "lead bigint, whole bigint, doc bigint, at bigint, tie bigint"))
    least = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(least, -(-suffixes.count() // BUCKET_ROWS))
    order = suffixes.repartitionByRange(buckets, "lead", "whole", "doc", "at").mapInArrow(_sort_bucket, _SORTED)
    order = stored(order)
    # one row per bucket and string: compare with the last string of the bucket before
    edges = order.filter(F.col("kind") != REPEAT)
    before = W.orderBy("bucket")
    finals = edges.filter(F.col("kind") == FINAL).select(
        "bucket", F.lag("lead").over(before).alias("lead"), F.lag("whole").over(before).alias("whole")
    )
    crossing = edges.filter(F.col("kind") == FIRST).join(F.broadcast(finals), ["bucket", "lead", "whole"], "left_semi")
    one = (F.shiftleft("at", 32)).bitwiseOR(F.col("at") + LENGTH)
    found = (
        met.filter("repeat").select("doc", "tie", _place().alias("span"))
        .unionByName(met_blocks.filter("repeat").select("doc", "tie", _place().alias("span")))
        .unionByName(order.filter(F.col("kind") == REPEAT).select("doc", "tie", one.alias("span")))
        .unionByName(crossing.select("doc", "tie", one.alias("span")))
    )
    spans = found.groupBy("doc", "tie").agg(F.collect_list("span").alias("spans"))
    spans = stored(spans.mapInArrow(_joined, "doc bigint, tie bigint, spans array<bigint>"))
    return _with_lists(tied, spans, "spans", "left").select("doc_id", "text", "spans")


_REPORT = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"


def _report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, n, data, offsets in text_slices(batch.column("text")):
            gone = removed_mask(batch.column("spans").slice(first, n), offsets)
            rises = gone.astype(np.int8)
            rises[1:] -= (gone[1:] & gone[:-1]).astype(np.int8)
            heads = offsets[:-1][offsets[:-1] < offsets[1:]]
            rises[heads] = gone[heads]
            total = np.r_[0, np.cumsum(gone)], np.r_[0, np.cumsum(rises, dtype=np.int64)]
            removed, spans = (t[offsets[1:]] - t[offsets[:-1]] for t in total)
            digests = [
                hashlib.sha256(data[a:b][~gone[a:b]].tobytes()).hexdigest()
                for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)
            ]
            yield _batch({
                "doc_id": batch.column("doc_id").slice(first, n), "n_bytes": np.diff(offsets), "n_removed": removed,
                "n_spans": spans, "kept_sha256": pa.array(digests, pa.string()),
            })


def removed_mask(spans: pa.Array, offsets: np.ndarray) -> np.ndarray:
    """Whether each byte of a slice lies in one of the spans of its text."""
    row = np.repeat(np.arange(len(spans)), spans.value_lengths().fill_null(0).to_numpy())
    packed = spans.flatten().to_numpy()
    delta = np.zeros(int(offsets[-1]) + 1, np.int64)
    np.add.at(delta, (packed >> 32) + offsets[row], 1)
    np.add.at(delta, (packed & 0xFFFFFFFF) + offsets[row], -1)
    return np.cumsum(delta[:-1]) > 0


def dedup_report(docs: DataFrame) -> DataFrame:
    """One row per document: bytes, removed bytes, removed runs, digest of what is left."""
    return repeated_spans(docs).mapInArrow(_report, _REPORT)


SQL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, CAST(strlen(coalesce(text, '')) AS BIGINT) AS n FROM documents),
w AS (SELECT doc_id, s, md5(substr(h, 2 * s + 1, 200)) AS g FROM (SELECT doc_id, h, unnest(range(n - 99)) AS s FROM d WHERE n >= 100)),
f AS (SELECT g, arg_min({'d': doc_id, 's': s}, {'d': doc_id, 's': s}) AS first FROM w GROUP BY g HAVING count(*) > 1),
x AS (SELECT doc_id, s, lag(s) OVER (PARTITION BY doc_id ORDER BY s) AS before FROM w JOIN f USING (g) WHERE NOT (doc_id = first.d AND s = first.s)),
r AS (SELECT *, sum(CASE WHEN before IS NULL OR s - before > 100 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY s) AS run FROM x),
spans AS (SELECT doc_id, run, min(s) AS a, max(s) + 100 AS b FROM r GROUP BY doc_id, run),
gaps AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM spans),
kept AS (SELECT doc_id, sum(b - a) AS removed, count(*) AS n_spans, max(b) AS behind,
    string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS text FROM gaps JOIN d USING (doc_id) GROUP BY doc_id)
SELECT d.doc_id, d.n AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
    sha256(unhex(coalesce(kept.text, '') || substr(h, 2 * coalesce(behind, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""
