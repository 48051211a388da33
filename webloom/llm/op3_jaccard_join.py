"""Exact Jaccard self-join of documents on word n-grams, with skipping by set relations.

1. A scan turns each text into its set of n-gram hashes, a 128-bit digest of the set and
   its index entries. Equal sets are one class from here on, and only the class's least
   document goes on, so copies cost nothing.
2. Index entries are exact: n-grams are dealt into more parts than two linked sets can have
   differing n-grams, so linked sets have a part in common, and entries are hashes of whole
   parts. Parts depend on a size class; a set is entered for its own class and, if it
   may link with larger sets of the next one, for that too. Parts without an n-gram are
   skipped, as extra parts make up for them (sets with more of them enter them too).
3. Of sets that meet in an entry, sizes and parity bitmaps rule out most that are not similar,
   by a lower bound of the difference. The others are linked, at most one link per set, and the
   components of these links are the groups in which answers are to be sought. Over
   ``BLOCK_SETS`` sets that meet in an entry are compared in blocks dealt by a hash, with some
   of the sets in all blocks, and then by size bands only where these links leave sets apart.
4. A group is joined locally through inverted lists cut into blocks by position in size
   order, so that blocks of sets too small or too large are skipped, and the overlap
   counts of a set are derived from those of the preceding, similar set by its differing
   n-grams only. Only links that join components are put out, at most one per set and
   component. Groups over ``BLOCK_SETS`` sets are cut into blocks by size, of which only
   those near enough in size meet, so no task holds more than two blocks.

Shuffled are thin rows, index entries and the texts of documents that met another in an
entry. Nothing is dropped at any size.

Null and empty texts have an empty set (size 0) and are linked with nothing. Rows without
a doc_id have no component (null). If a doc_id repeats, its rows count as one document.
Other columns of the input are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webloom.llm.components import components
from webloom.llm.storage import join_checked, stored
from webloom.llm.words import NOT_BLANK, SLICE_BYTES, U64, Words, gram_hashes, mix, text_slices, within_rows

COUNTER_BITS = 18
COUNTERS = 1 << COUNTER_BITS
MAPS = 200_000  # most bitmaps that are broadcast
BLOCK_SETS = 1024
BLOCK_BYTES = 6 << 20  # of text, of all sets in a block
HUBS = 16  # sets of a cut group that all its blocks have, about
LOOSE_BLOCKS = 16  # most blocks of a loose group that meet each other; index entries cost about as many rows a set
BAND_STEP = 1 << 40
LIST_BLOCK = 64  # positions in a block of an inverted list


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct k-gram hashes of each text, sorted, with their rows. A text of fewer words is one gram."""
    words = Words(data, offsets, NOT_BLANK)
    return gram_sets(words.hashes(), words.firsts, k)


def gram_sets(hashes: np.ndarray, firsts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """``shingle_sets`` of texts whose words' hashes are ``hashes[firsts[r] : firsts[r + 1]]``."""
    counts = np.diff(firsts)
    of = np.repeat(np.arange(len(counts)), counts)
    at = np.flatnonzero(within_rows(of, k))
    grams, rows = [gram_hashes(hashes, k)[at]], [of[at]]
    for few in range(1, k):
        short = np.flatnonzero(counts == few)
        if len(short):
            grams.append(gram_hashes(hashes[firsts[short][:, None] + np.arange(few)].T, few)[0])
            rows.append(short)
    grams, rows = np.concatenate(grams), np.concatenate(rows)
    order = np.lexsort((grams, rows))
    grams, rows = grams[order], rows[order]
    new = np.ones(len(grams), bool)
    new[1:] = (grams[1:] != grams[:-1]) | (rows[1:] != rows[:-1])
    return grams[new], rows[new]


class Parts:
    """Size classes and the number of parts of each, for similarity ``num / den``.

    Sets of similarity s differ in at most (1 - s) / (1 + s) of their joint size. Class t
    serves pairs whose larger set has from ``low[t]`` to ``low[t + 1] - 1`` n-grams.
    """

    def __init__(self, num: int, den: int, largest: int):
        self.num, self.den = num, den
        low = [1]
        while low[-1] <= largest:
            low.append(max(low[-1] + 1, low[-1] * 6 * den // (5 * num)))
        low.append(max(low[-1] + 1, low[-1] * 6 * den // (5 * num)))  # as in slices with larger sets
        self.low = np.array(low)
        parts, spare = [], []
        for least, top in zip(self.low[:-1], self.low[1:] - 1, strict=True):
            need = 2 * int(top) * (den - num) // (den + num) + 1
            smallest = -(-int(least) * num // den)
            extra = 0
            for _ in range(4):  # as many spare parts as twice the parts expected to be empty
                n = need + extra
                extra = 0 if need == 1 else max(1, int(np.ceil(2 * n * np.exp(-smallest / n))))
            parts.append(need + extra)
            spare.append(extra)
        self.parts, self.spare = np.array(parts), np.array(spare)

    def of(self, sizes: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.low, sizes, "right") - 1


def _cells(grams, rows, n, used, tag, plan, seed):
    """Hash of each part of the sets in use, and its set, part number and whether it is filled."""
    parts = np.where(used, plan.parts[tag], 0)
    first = np.r_[0, np.cumsum(parts)]
    salted = mix(grams + mix(tag[rows].astype(U64) + U64(seed)))
    cell = first[rows] + (salted % np.maximum(parts[rows], 1).astype(U64)).astype(np.int64)
    sums = np.zeros(first[-1], U64)
    np.add.at(sums, cell, salted)
    filled = np.bincount(cell, minlength=first[-1]) > 0
    owner = np.repeat(np.arange(n), parts)
    number = np.arange(first[-1]) - first[owner]
    entry = mix(sums + mix(tag[owner].astype(U64) * U64(1 << 32) + number.astype(U64) + U64(seed)))
    short = np.bincount(owner, weights=~filled, minlength=n) > plan.spare[tag]
    return entry, owner, filled, short


def index_entries(
    grams: np.ndarray, rows: np.ndarray, n: int, num: int, den: int, frequent: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Index entries of the sets, and the number of entries of each row. ``frequent``: of the grams."""
    sizes = np.bincount(rows, minlength=n)
    plan = Parts(num, den, int(sizes.max(initial=1)))
    own = plan.of(np.maximum(sizes, 1))
    rare = np.ones(len(grams), bool) if frequent is None else ~frequent
    entries, owners = [np.zeros(0, U64)], [np.zeros(0, np.int64)]
    for step in (0, 1):
        tag = own + step
        used = (sizes > 0) & (True if step == 0 else sizes * den >= num * plan.low[tag])
        mine = used[rows] & rare
        entry, owner, filled, short = _cells(grams[mine], rows[mine], n, used, tag, plan, 77)
        entries.append(entry[filled])
        owners.append(owner[filled])
        # sets with too many empty parts: by all their n-grams, and by empty parts if still too many
        poor = used & short
        mine = poor[rows]
        entry, owner, filled, short = _cells(grams[mine], rows[mine], n, poor, tag, plan, 99)
        keep = filled | short[owner]
        entries.append(entry[keep])
        owners.append(owner[keep])
    entries, owners = np.concatenate(entries), np.concatenate(owners)
    order = np.argsort(owners, kind="stable")
    return entries[order], np.bincount(owners, minlength=n)


_SET = "doc_id bigint, n_shingles bigint, d1 bigint, d2 bigint, counter bigint"


def _set_batch(doc_id: pa.Array, sizes: np.ndarray, d1: np.ndarray, d2: np.ndarray, counter: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [doc_id, pa.array(sizes), pa.array(d1.view(np.int64)), pa.array(d2.view(np.int64)), counter],
        ["doc_id", "n_shingles", "d1", "d2", "counter"],
    )


def _sets(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Size and digest of each text's set; at the end, as rows with a counter, n-grams by counter."""
    total = np.zeros(COUNTERS, np.int64)
    for batch in batches:
        for first, n, data, offsets in text_slices(batch.column("text")):
            grams, rows = shingle_sets(data, offsets, k)
            total += np.bincount((grams >> U64(64 - COUNTER_BITS)).astype(np.int64), minlength=COUNTERS)
            d1, d2 = np.zeros(n, U64), np.zeros(n, U64)
            np.add.at(d1, rows, mix(grams + U64(1)))
            np.add.at(d2, rows, mix(grams ^ U64(0x5851F42D4C957F2D)))
            sizes = np.bincount(rows, minlength=n).astype(np.int64)
            yield _set_batch(batch.column("doc_id").slice(first, n), sizes, d1, d2, pa.nulls(n, pa.int64()))
    at = np.flatnonzero(total)
    none = np.zeros(len(at), U64)
    yield _set_batch(pa.nulls(len(at), pa.int64()), total[at], none, none, pa.array(at))


def frequent_counters(counted: DataFrame) -> np.ndarray:
    """Which counters hold far more n-grams than usual. Their number is fixed, whatever the data."""
    total = np.zeros(COUNTERS)
    known = counted.groupBy("counter").agg(F.sum("n_shingles").alias("n")).toPandas()
    total[known["counter"].to_numpy(dtype=np.int64)] = known["n"].to_numpy()
    usual = np.median(total)
    return total > usual + 8 * np.sqrt(usual) + 8


def _entries(batches: Iterator[pa.RecordBatch], k: int, num: int, den: int, hot: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Entries of each set."""
    for batch in batches:
        ids = batch.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64)
        for first, n, data, offsets in text_slices(batch.column("text")):
            grams, rows = shingle_sets(data, offsets, k)
            frequent = hot[(grams >> U64(64 - COUNTER_BITS)).astype(np.int64)]
            entries, counts = index_entries(grams, rows, n, num, den, frequent)
            docs = np.repeat(ids[first : first + n], counts)
            yield pa.RecordBatch.from_arrays([pa.array(entries.view(np.int64)), pa.array(docs)], ["entry", "doc_id"])


def _meetings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of each entry that several have, from rows sorted by entry and document.

    ``g`` is a hash of all the documents, as the same ones mostly meet in many entries; a group that
    goes over a batch goes by its entry, and what is kept of it is one row.
    """
    held_entry, held_doc, put_out = None, None, True  # the open entry, its document if not put out yet
    for batch in batches:
        entry, doc = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("entry", "doc_id"))
        if not len(entry):
            continue
        heads = np.flatnonzero(np.r_[True, entry[1:] != entry[:-1]])
        sizes = np.diff(np.r_[heads, len(entry)])
        group = np.repeat(np.arange(len(heads)), sizes)
        names = mix(np.add.reduceat(mix(doc.view(U64)), heads) + sizes.astype(U64))
        several = sizes > 1
        continued = entry[0] == held_entry
        names[-1] = mix(entry[-1:].view(U64))[0]
        extra = ([], [])
        if continued:
            names[0] = mix(entry[:1].view(U64))[0]
            several[0] = True
            if not put_out:
                extra = ([names[0]], [held_doc])
        keep = several[group]
        held_entry, held_doc, put_out = entry[-1], doc[-1], bool(several[-1])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.r_[np.array(extra[0], U64), names[group[keep]]].view(np.int64)),
             pa.array(np.r_[np.array(extra[1], np.int64), doc[keep]])], ["g", "doc_id"],
        )


def _bitmaps(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Parity bitmaps: each n-gram flips a bit, so two sets differ in at least as many n-grams as
    their bitmaps differ in bits. A bitmap has a power of two of bits, about half the set's size."""
    for batch in batches:
        for first, n, data, offsets in text_slices(batch.column("text")):
            grams, rows = shingle_sets(data, offsets, k)
            sizes = np.bincount(rows, minlength=n)
            bits = _bitmap_bits(sizes)
            starts = np.r_[0, np.cumsum(bits)]
            flips = np.bincount(starts[rows] + (mix(grams) % bits[rows].astype(U64)).astype(np.int64), minlength=starts[-1])
            packed = np.packbits((flips & 1).astype(np.uint8), bitorder="little")
            ends = (starts // 8).astype(np.int32)
            maps = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(ends), pa.py_buffer(packed)])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(first, n), pa.array(sizes.astype(np.int64)), maps], ["doc_id", "n", "bits"]
            )


def _bitmap_bits(sizes: np.ndarray) -> np.ndarray:
    return 1 << np.ceil(np.log2(np.maximum(sizes / 2, 64))).astype(np.int64)


def _folded(bitmap: np.ndarray, words: int) -> np.ndarray:
    """The bitmap with fewer bits: halves cancel out."""
    while bitmap.shape[-1] > words:
        half = bitmap.shape[-1] // 2
        bitmap = bitmap[..., :half] ^ bitmap[..., half:]
    return bitmap


def possible_links(sizes: np.ndarray, maps: list[np.ndarray], side: np.ndarray, num: int, den: int) -> list[tuple[int, int]]:
    """A forest of the pairs of sets that sizes and bitmaps do not rule out; side as in ``group_links``."""
    order = np.argsort(sizes, kind="stable")
    size, sides = sizes[order], side[order]
    levels: dict[int, tuple[int, np.ndarray]] = {}
    label, links = np.arange(len(order)), []
    for i in range(len(order) - 1):
        high = int(np.searchsorted(size * num, size[i] * den, "right"))
        if high <= i + 1:
            continue
        words = len(maps[order[i]])
        if words not in levels:
            levels[words] = i, np.stack([_folded(maps[o], words) for o in order[i:]])  # larger sets have no smaller bitmaps
        first, table = levels[words]
        apart = np.bitwise_count(table[i + 1 - first : high - first] ^ table[i - first]).sum(axis=1)
        near = np.flatnonzero(apart * (den + num) <= (den - num) * (size[i + 1 : high] + size[i])) + i + 1
        if sides[i] != 2:
            near = near[sides[near] != sides[i]]
        for j in near.tolist():
            if label[j] != label[i]:
                links.append((int(order[j]), int(order[i])))
                label[label == label[j]] = label[i]
    return links


def _possible(batches: Iterator[pa.RecordBatch], num: int, den: int) -> Iterator[pa.RecordBatch]:
    """Links within each group or pair of blocks, from rows sorted by them."""
    key, ids, sizes, maps, sides, found = None, [], [], [], [], set()

    def close() -> None:
        if len(ids) > 1:
            found.update((ids[a], ids[b]) for a, b in possible_links(np.array(sizes), maps, np.array(sides), num, den))

    for batch in batches:
        rows = zip(*(batch.column(c).to_pylist() for c in ("g", "i", "j", "doc_id", "n", "bits", "side")), strict=True)
        for g, i, j, doc, n, bits, side in rows:
            if (g, i, j) != key:
                close()
                key, ids, sizes, maps, sides = (g, i, j), [], [], [], []
            ids.append(doc)
            sizes.append(n)
            maps.append(np.frombuffer(bits, U64))
            sides.append(side)
        if len(found) > 10_000:
            yield _links(found)
            found = set()
    close()
    yield _links(found)


def _links(found: set[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([a for a, _ in found], pa.int64()), pa.array([b for _, b in found], pa.int64())], ["a", "b"]
    )


class Lists:
    """Inverted lists of a group of sets in size order, cut into blocks by position."""

    def __init__(self, tokens: np.ndarray, places: np.ndarray, n: int):
        order = np.lexsort((places, tokens))
        self.places, tokens = places[order], tokens[order]
        self.blocks = -(-n // LIST_BLOCK)
        kinds = int(tokens[-1]) + 1 if len(tokens) else 0
        cell = tokens * self.blocks + self.places // LIST_BLOCK
        self.ptr = np.searchsorted(cell, np.arange(kinds * self.blocks + 1))
        self.n = n

    def counts(self, tokens: np.ndarray, low: int, high: int) -> np.ndarray:
        """How many of the tokens each set holds; right for positions from low to high."""
        first = self.ptr[tokens * self.blocks + low // LIST_BLOCK]
        last = self.ptr[tokens * self.blocks + (high - 1) // LIST_BLOCK + 1]
        lengths = last - first
        at = np.repeat(first - np.r_[0, np.cumsum(lengths)[:-1]], lengths) + np.arange(lengths.sum())
        return np.bincount(self.places[at], minlength=self.n)


def group_links(sets: list[np.ndarray], side: np.ndarray, num: int, den: int) -> list[tuple[int, int]]:
    """Links that join the linked sets of a group; side: 0 and 1 meet each other only, 2 meets all."""
    sizes = np.array([len(s) for s in sets])
    order = np.argsort(sizes, kind="stable")
    size = sizes[order]
    n = len(sets)
    flat = np.concatenate([sets[i] for i in order])
    place = np.repeat(np.arange(n), size)
    _, tokens, times = np.unique(flat, return_inverse=True, return_counts=True)
    shared = times[tokens] > 1  # an n-gram of one set only takes no part in any overlap
    renumber = np.cumsum(times > 1) - 1
    tokens, place = renumber[tokens[shared]], place[shared]
    lists = Lists(tokens, place, n)
    ends = np.r_[0, np.cumsum(np.bincount(place, minlength=n))]
    own = [tokens[ends[i] : ends[i + 1]] for i in range(n)]
    low = np.searchsorted(size * den, size * num)  # first position that is large enough for each
    high = np.searchsorted(size * num, size * den, "right")
    label, links = np.arange(n), []
    sides = side[order]
    # similar sets one after the other: by their least n-gram
    walk = np.lexsort((size, [int(x.min()) if len(x) else -1 for x in own]))
    done = np.zeros(n, bool)
    before, known, span = None, None, (0, 0)
    for i in walk.tolist():
        reach = (int(low[i]), int(high[i]))
        counts = None
        if before is not None and span[0] <= reach[0] and reach[1] <= span[1]:
            gone = np.setdiff1d(own[before], own[i], assume_unique=True)
            come = np.setdiff1d(own[i], own[before], assume_unique=True)
            if len(gone) + len(come) < len(own[i]):
                counts = known - lists.counts(gone, *span) + lists.counts(come, *span)
        if counts is None:
            # a little wider than this set needs, so that answers of similar sets derive from it
            span = (int(low[max(0, reach[0])]), int(high[reach[1] - 1]))
            counts = lists.counts(own[i], *span)
        before, known = i, counts
        at = np.arange(*reach)
        overlap = counts[at]
        linked = (overlap * (num + den) >= num * (size[i] + size[at])) & done[at]
        if sides[i] != 2:
            linked &= sides[at] != sides[i]
        done[i] = True
        for j in at[linked].tolist():
            if label[j] != label[i]:
                links.append((int(order[i]), int(order[j])))
                label[label == label[j]] = label[i]
    return links


def _pair_links(one: np.ndarray, other: np.ndarray, side: np.ndarray, num: int, den: int) -> list[tuple[int, int]]:
    """``group_links`` of two sets, which most groups are."""
    if side[0] == side[1] != 2:
        return []
    both = np.concatenate((one, other))
    both.sort()
    overlap = np.count_nonzero(both[1:] == both[:-1])
    return [(1, 0)] if overlap * (num + den) >= num * len(both) else []


def _group(groups: list[tuple[list, list, list]], k: int, num: int, den: int) -> pa.RecordBatch:
    """Links of groups (ids, texts, sides), whose sets are made at once."""
    sets: list[np.ndarray] = []
    for _, n, data, offsets in text_slices(pa.array([t for _, texts, _ in groups for t in texts], pa.large_string()), SLICE_BYTES):
        grams, rows = shingle_sets(data, offsets, k)
        sets += np.split(grams, np.cumsum(np.bincount(rows, minlength=n))[:-1])
    a, b, at = [], [], 0
    for ids, _, sides in groups:
        own, side = sets[at : at + len(ids)], np.array(sides)
        at += len(ids)
        for x, y in _pair_links(*own, side, num, den) if len(ids) == 2 else group_links(own, side, num, den):
            a.append(ids[x])
            b.append(ids[y])
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def _groups(batches: Iterator[pa.RecordBatch], k: int, num: int, den: int) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by group; a group may span batches. Small groups are taken many at a time."""
    key, group, size, ready, held = None, ([], [], []), 0, [], 0
    for batch in batches:
        rows = batch.to_pydict()
        for c, i, j, doc, text, side in zip(*(rows[x] for x in ("c", "i", "j", "doc_id", "text", "side")), strict=True):
            if (c, i, j) != key:
                if len(group[0]) > 1:
                    if ready and held + size > SLICE_BYTES:
                        yield _group(ready, k, num, den)
                        ready, held = [], 0
                    ready.append(group)
                    held += size
                key, group, size = (c, i, j), ([], [], []), 0
            for values, value in zip(group, (doc, text, side), strict=True):
                values.append(value)
            size += len(text or "")
    if len(group[0]) > 1:
        ready.append(group)
    if ready:
        yield _group(ready, k, num, den)


def _band(size: str, num: int, den: int) -> Column:
    """Linked sets are in the same band of sizes or in neighbouring ones."""
    return F.floor(F.log(F.greatest(size, F.lit(1))) / (math.log(den / num) * 1.0001)).cast("bigint")


def _own_block(kind: Column) -> Column:
    """A document's block of its kind, by the map ``blocks`` of the kinds' numbers of blocks."""
    return kind * BAND_STEP + F.pmod(F.xxhash64("doc_id"), F.try_element_at("blocks", kind))


def _all_blocks(kinds: Column) -> Column:
    return F.flatten(
        F.transform(
            kinds,
            lambda b: F.when(
                F.coalesce(F.try_element_at("blocks", b), F.lit(0)) > 0,
                F.transform(F.sequence(F.lit(0).cast("bigint"), F.try_element_at("blocks", b) - 1), lambda x: b * BAND_STEP + x),
            ).otherwise(F.array().cast("array<bigint>")),
        )
    )


def _pair(mine: str, other: str) -> list[Column]:
    """A block on its own meets itself in (i, i); blocks i < j meet each other in (i, j)."""
    return [
        F.least(mine, other).alias("i"), F.greatest(mine, other).alias("j"),
        F.when(F.col(mine) == F.col(other), 2).when(F.col(mine) < F.col(other), 0).otherwise(1).alias("side"),
    ]


def meeting_links(
    met: DataFrame, maps: DataFrame, num: int, den: int, block_sets: int = BLOCK_SETS, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """Links ``a, b`` that join the sets of each group that sizes and bitmaps do not rule out.

    ``met``: g (the group), doc_id. ``maps``: doc_id, n, bits. A group of more sets or longer bitmaps
    than a block is dealt into blocks by a hash, with about ``HUBS`` of its sets in all of them.
    Links found there name a most common component; only sets outside it then meet the group's
    other sets, in pairs of blocks near in size. So m near copies cost about m rows for each entry, and
    only sets that are not near, m * m / ``block_sets`` rows.
    """

    def linked(dealt: DataFrame) -> DataFrame:
        keys = ("g", "i", "j")
        rows = dealt.select(*keys, "doc_id", "n", "bits", "side").repartition(*keys).sortWithinPartitions(*keys, "doc_id")
        return rows.mapInArrow(partial(_possible, num=num, den=den), "a bigint, b bigint")

    none, count = F.lit(0).cast("bigint"), F.count(F.lit(1))
    blocks = F.ceil(F.greatest(count / block_sets, F.sum("n") / (8 * block_bytes))).cast("bigint")  # at most n bits a set
    sizes = maps.select("doc_id", "n").distinct()
    large = stored(
        join_checked(met, sizes, ["doc_id"]).groupBy("g").agg(
            blocks.alias("blocks"), count.alias("sets"), F.sum(F.xxhash64("doc_id").cast("decimal(38,0)")).alias("same")
        ).filter("blocks > 1")
    )
    some = not large.isEmpty()
    rest = join_checked(met, large.select("g"), ["g"], "left_anti") if some else met
    alone = join_checked(rest, maps, ["doc_id"], most=MAPS)
    links = stored(linked(alone.withColumns({"i": none, "j": none, "side": F.lit(2)})))
    if not some:
        return links

    # the same documents may meet in several entries
    kept = stored(large.groupBy("sets", "same").agg(F.min("g").alias("g"), F.first("blocks").alias("blocks")))
    cut = stored(join_checked(met, kept.select("g", "sets", "blocks"), ["g"]))
    hub = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.ceil(F.col("sets") / HUBS)) == 0
    places = F.when(hub, F.sequence(none, F.col("blocks") - 1)).otherwise(F.array(F.pmod(F.xxhash64("doc_id"), "blocks")))
    dealt = join_checked(cut.select("g", "doc_id", places.alias("places")), maps, ["doc_id"], most=MAPS)
    dealt = dealt.withColumn("i", F.explode("places"))
    first = stored(linked(dealt.withColumns({"j": F.col("i"), "side": F.lit(2)})))

    labels = stored(components(first).withColumnsRenamed({"node": "doc_id", "component": "label"}))
    named = join_checked(cut.select("g", "doc_id"), labels, ["doc_id"], "left")
    named = stored(named.select("g", "doc_id", F.coalesce("label", "doc_id").alias("label")))
    common = named.groupBy("g", "label").agg(count.alias("sets")).groupBy("g").agg(
        F.max_by("label", F.struct("sets", "label")).alias("most")
    )
    apart = join_checked(named, stored(common), ["g"]).select("g", "doc_id", (F.col("label") != F.col("most")).cast("bigint").alias("apart"))
    # sets of the most common component are of even kinds, the others of odd ones
    kinds = stored(
        join_checked(apart, sizes, ["doc_id"]).select("g", "doc_id", "n", (_band("n", num, den) * 2 + F.col("apart")).alias("kind"))
    )
    plan = kinds.groupBy("g", "kind").agg(blocks.alias("blocks")).groupBy("g").agg(
        F.map_from_entries(F.collect_list(F.struct("kind", "blocks"))).alias("blocks"), F.max(F.col("kind") % 2).alias("any")
    )
    placed = join_checked(kinds, stored(plan.filter("any = 1").drop("any")), ["g"])
    odd = F.col("kind") % 2 == 1
    base = F.col("kind") - F.col("kind") % 2
    meets = F.when(odd, F.array(*(base + x for x in range(-2, 4)))).otherwise(F.array(*(base + x for x in (-1, 1, 3))))
    placed = stored(placed.select("g", "doc_id", "n", _own_block(F.col("kind")).alias("mine"), _all_blocks(meets).alias("others")))
    dealt = join_checked(placed.filter(F.size("others") > 0), maps, ["doc_id", "n"], most=MAPS)
    dealt = dealt.withColumn("other", F.explode("others")).select("g", "doc_id", "n", "bits", *_pair("mine", "other"))
    return stored(links.unionByName(first).unionByName(linked(dealt)))


def links_within(
    docs: DataFrame, sized: DataFrame, k: int, num: int, den: int, block_sets: int = BLOCK_SETS,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Links ``a, b`` that join the similar documents of each group.

    ``docs``: doc_id, text. ``sized``: doc_id, n_shingles, c (its group).
    """
    # a doc_id with several texts has a row for the band of each
    sized = stored(sized.withColumn("band", _band("n_shingles", num, den)))
    count, grams = F.count(F.lit(1)), F.sum("n_shingles")
    bands = sized.groupBy("c", "band").agg(
        count.alias("n"), grams.alias("w"),
        F.ceil(F.greatest(count / block_sets, grams * 8 / block_bytes)).cast("bigint").alias("blocks"),
    )
    plan = stored(
        bands.groupBy("c").agg(
            F.map_from_entries(F.collect_list(F.struct("band", "blocks"))).alias("blocks"),
            ((F.sum("n") > block_sets) | (F.sum("w") * 8 > block_bytes)).alias("cut"),
        )
    )
    placed = join_checked(sized.select("doc_id", "c", "band").distinct(), plan, ["c"])
    own = _own_block(F.col("band"))
    near = _all_blocks(F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1))
    placed = stored(
        placed.select(
            "doc_id", "c", F.when(F.col("cut"), own).otherwise(F.lit(0)).alias("mine"),
            F.when(F.col("cut"), near).otherwise(F.array(F.lit(0).cast("bigint"))).alias("others"),
        )
    )
    texts = join_checked(docs, placed, ["doc_id"])
    dealt = texts.select("c", "mine", "doc_id", "text", F.explode("others").alias("other")).select(
        "c", "doc_id", "text", *_pair("mine", "other")
    )
    return stored(
        dealt.repartition("c", "i", "j").sortWithinPartitions("c", "i", "j", "doc_id")
        .mapInArrow(partial(_groups, k=k, num=num, den=den), "a bigint, b bigint")
    )


def possible_groups(
    docs: DataFrame, k: int, num: int, den: int, hot: np.ndarray, block_sets: int = BLOCK_SETS, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """``doc_id, c``: groups in which all links of the documents are, by index entries and bitmaps. Others have no link."""
    entered = docs.mapInArrow(partial(_entries, k=k, num=num, den=den, hot=hot), "entry bigint, doc_id bigint")
    met = entered.repartition("entry").sortWithinPartitions("entry", "doc_id").mapInArrow(_meetings, "g bigint, doc_id bigint")
    met = stored(met.distinct())
    ids = stored(met.select("doc_id").distinct())
    maps = join_checked(docs, ids, ["doc_id"]).mapInArrow(partial(_bitmaps, k=k), "doc_id bigint, n bigint, bits binary")
    members = components(meeting_links(met, stored(maps), num, den, block_sets, block_bytes))
    return stored(members.withColumnsRenamed({"node": "doc_id", "component": "c"}))


def finer_groups(
    docs: DataFrame, sized: DataFrame, k: int, num: int, den: int, block_sets: int = BLOCK_SETS, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """``sized`` (as in ``links_within``) with groups of over ``LOOSE_BLOCKS`` blocks replaced by their ``possible_groups``.

    For groups made of loose links, which grow together with the data though few of their sets are similar:
    all their blocks would meet. No link within a group is lost; sets that have none go.
    """
    blocks = F.greatest(F.count(F.lit(1)) / block_sets, F.sum("n_shingles") * 8 / block_bytes)
    large = stored(sized.groupBy("c").agg(blocks.alias("blocks")).filter(F.col("blocks") > LOOSE_BLOCKS).select("c"))
    if large.isEmpty():
        return sized
    loose = stored(join_checked(sized, large, ["c"]).select("doc_id", "n_shingles"))
    texts = stored(join_checked(docs, loose.select("doc_id").distinct(), ["doc_id"]))
    hot = frequent_counters(texts.mapInArrow(partial(_sets, k=k), _SET).filter("counter IS NOT NULL"))
    finer = join_checked(loose, possible_groups(texts, k, num, den, hot, block_sets, block_bytes), ["doc_id"])
    return join_checked(sized, large, ["c"], "left_anti").select("doc_id", "n_shingles", "c").unionByName(finer)


def similar_groups(
    docs: DataFrame, k: int = 5, num: int = 8, den: int = 10, block_sets: int = BLOCK_SETS,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row; sets link at similarity ``num / den`` or more.

    ``docs`` has ``doc_id`` and ``text``. A component is named by its least doc_id. The
    similarity must be over 0.5.
    """
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    counted = stored(docs.mapInArrow(partial(_sets, k=k), _SET))
    hot = frequent_counters(counted.filter("counter IS NOT NULL"))
    sets = counted.filter("counter IS NULL").drop("counter")
    usable = sets.filter((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    classes = stored(usable.groupBy("d1", "d2").agg(F.min("doc_id").alias("rep")))
    # of equal sets only the least document goes on; a doc_id that has a set of its own does, too
    reps = classes.select(F.col("rep").alias("doc_id")).distinct()
    others = stored(usable.select("doc_id").join(reps, "doc_id", "left_anti").distinct())
    going = join_checked(docs.filter(F.col("doc_id").isNotNull()), others, ["doc_id"], "left_anti")
    members = possible_groups(going, k, num, den, hot, block_sets, block_bytes)

    sized = join_checked(sets.select("doc_id", "n_shingles"), members, ["doc_id"])
    links = links_within(docs.filter(F.col("doc_id").isNotNull()), sized, k, num, den, block_sets, block_bytes)
    found = components(links).withColumnsRenamed({"node": "rep", "component": "component_id"})
    named = stored(
        classes.join(found, "rep", "left").select("d1", "d2", F.coalesce("component_id", "rep").alias("component_id"))
    )
    # a doc_id with several texts belongs to the least component of any of them
    keyed = sets.select("doc_id", "n_shingles", "d1", "d2")
    return join_checked(keyed, named, ["d1", "d2"], "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")))
        .alias("component_id"),
    )


def keep_one_of_each(docs: DataFrame, **similarity) -> DataFrame:
    """One document of each group of similar ones, the least doc_id, with all its columns.

    Documents without words or doc_id are kept. Of rows that repeat a doc_id, those of the kept
    id stay.
    """
    groups = similar_groups(docs.select("doc_id", "text"), **similarity)
    others = stored(groups.filter("component_id <> doc_id").select("doc_id").distinct())
    return join_checked(docs, others, ["doc_id"], "left_anti")


SQL = """
WITH RECURSIVE t AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(words[p : p + 2], ' ') AS gram
    FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 1, 2))) AS p FROM t WHERE len(words) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS i FROM s x JOIN s y ON x.gram = y.gram AND x.doc_id <> y.doc_id GROUP BY ALL),
links AS MATERIALIZED (SELECT a, b FROM o JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * i >= 90 * (p.n + q.n - i)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM t UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT t.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, min(reach.b) AS component_id
FROM t LEFT JOIN n USING (doc_id) JOIN reach ON reach.a = t.doc_id GROUP BY t.doc_id, n.n
"""
