"""Repeated passages: paragraphs that equal or resemble others, by MinHash bands.

Paragraphs are lines of at least ``LEAST_WORDS`` words. A shorter line, of verse or a list, begins a paragraph with the lines that
follow until there are as many words; at the end of a text the last lines that have as many are one, and a text of fewer words is one as a
whole. So every line is in a paragraph. Each gets MinHash values over its
five-word shingles, in bands whose number and width are tuned for a stated recall at the
similarity. Paragraphs that collide in a band are linked to the least of them, and within the components of
these links exact Jaccard similarity decides, by the blockwise local join of sets. Bands let pairs of little
similarity pass, so components grow together with the data; one of more than ``LOOSE_BLOCKS`` blocks of sets is first cut into the
groups that the exact index of ``op3`` leaves of it. What is similar enough is clustered by connected components. Sentences of longer lines take part by
equality alone, so that a passage is found where another line has more around it.

In a cluster the first place (least document, then start) stays and all others are to be
removed. Equal paragraphs are one node: bands are grouped with partial sums, and joined once per node where the join
shuffles, so a line that a third of all documents hold costs one row per occurrence and no pair. ``whole_line`` tells whole
lines from sentences and from paragraphs of several lines.

Null and empty texts have no paragraphs. Rows that repeat a doc_id and start are the same
place. Rows without a doc_id take part and come last. Columns other than doc_id and text are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webloom.llm.components import components
from webloom.llm.op3_jaccard_join import finer_groups, gram_sets, links_within
from webloom.llm.storage import join_checked, small, stored
from webloom.llm.words import NOT_BLANK, U64, Words, mix, text_slices

LEAST_WORDS = 8
SHINGLE = 5
NUM, DEN = 8, 10  # similarity
RECALL, CHANCE_AT, CHANCE = 0.999, 0.3, 0.5
LAST = (1 << 63) - 1
_PLACES = Decimal(1 << 50)  # more than a text has places


def tune_bands(similarity: float = NUM / DEN, recall: float = RECALL) -> tuple[int, int]:
    """Bands and rows per band: the fewest values that find a pair of the similarity with the
    recall and let a pair of similarity ``CHANCE_AT`` pass with a chance of ``CHANCE`` at most."""
    best = None
    for width in range(1, 9):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - similarity**width))
        if 1 - (1 - CHANCE_AT**width) ** bands <= CHANCE and (best is None or bands * width < best[0] * best[1]):
            best = (bands, width)
    return best


def bands_of(grams: np.ndarray, rows: np.ndarray, n: int, bands: int, width: int) -> np.ndarray:
    """Band hashes of each row's set, n x bands."""
    out = np.zeros((n, bands), U64)
    if not len(rows):
        return out
    heads = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
    for band in range(bands):
        total = np.full(len(heads), band + 1, U64)
        for j in range(width):
            seed = mix(np.full(1, band * width + j + 1, U64))
            total = mix(total * U64(0xFF51AFD7ED558CCD) + np.minimum.reduceat(mix(grams ^ seed), heads))
        out[rows[heads], band] = total
    return out


_UNIT = "doc bigint, key bigint, first bigint, behind bigint, n_words bigint, line boolean, banded boolean, node bigint, n_shingles bigint, bands array<bigint>"


def units(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Start, end, text and whether a line, of all lines and of the sentences of lines with several."""
    heads = offsets[:-1][offsets[:-1] < offsets[1:]]
    breaks = np.unique(np.r_[heads, offsets[-1:], np.flatnonzero(data == 10) + 1])
    first, end = breaks[:-1], breaks[1:]
    ends_sentence = np.isin(data[:-1], np.frombuffer(b".!?", np.uint8)) & (data[1:] == 0x20)
    stop = np.flatnonzero(ends_sentence) + 2
    cuts = np.unique(np.r_[breaks, stop[stop < len(data)]])
    s_first, s_end = cuts[:-1], cuts[1:]
    line = np.searchsorted(first, s_first, "right") - 1
    several = np.bincount(line, minlength=len(first))[line] > 1
    starts = np.r_[first, s_first[several]]
    ends = np.r_[end, s_end[several]]
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1, np.r_[np.ones(len(first), bool), np.zeros(several.sum(), bool)]


def short_line_runs(texts: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last line of the paragraphs that short lines make with others, from the text and the words of each line."""
    short = np.flatnonzero((words > 0) & (words < LEAST_WORDS))
    if not len(short):
        return short, short
    up = np.r_[0, np.cumsum(words)]
    text_first = np.searchsorted(texts, texts[short], "left")
    text_last = np.searchsorted(texts, texts[short], "right") - 1
    last = np.searchsorted(up, up[short] + LEAST_WORDS, "left") - 1
    # at the end of a text: the last lines with as many words, or all of it
    back = np.searchsorted(up, up[text_last + 1] - LEAST_WORDS, "right") - 1
    first = np.where(last > text_last, np.maximum(back, text_first), short)
    return np.unique(np.c_[first, np.minimum(last, text_last)], axis=0).T


def _gathered(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    ends_at = np.r_[0, np.cumsum(ends - starts)]
    at = np.repeat(starts - ends_at[:-1], ends - starts) + np.arange(ends_at[-1])
    return data[at], ends_at


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    bands, width = tune_bands()
    for batch in batches:
        docs, keys = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("doc", "key"))
        for row, n, data, offsets in text_slices(batch.column("text")):
            if not len(data):
                continue
            starts, ends, texts, line = units(data, offsets)
            # a unit is a run of words, as its ends are at blanks or ends of texts
            words = Words(data, offsets, NOT_BLANK)
            hashes = words.hashes()
            w_first, w_end = np.searchsorted(words.starts, starts), np.searchsorted(words.starts, ends)
            n_lines = int(line.sum())
            first, last = short_line_runs(texts[:n_lines], (w_end - w_first)[:n_lines])
            starts, ends, texts = np.r_[starts, starts[first]], np.r_[ends, ends[last]], np.r_[texts, texts[first]]
            w_first, w_end = np.r_[w_first, w_first[first]], np.r_[w_end, w_end[last]]
            counts = w_end - w_first
            run = np.arange(len(starts)) >= len(line)
            line = np.r_[line, np.zeros(len(first), bool)]
            # a digest of all words of a unit: their hashes, each with its place
            own, firsts = _gathered(hashes, w_first, w_end)
            place = np.arange(len(own)) - np.repeat(firsts[:-1], counts)
            node = np.zeros(len(starts), U64)
            np.add.at(node, np.repeat(np.arange(len(starts)), counts), mix(own + mix(place.astype(U64))))
            node = mix(node + counts.astype(U64))
            used = np.flatnonzero((counts >= LEAST_WORDS) | run)
            banded = line | run
            lines = used[banded[used]]
            grams, of = gram_sets(*_gathered(hashes, w_first[lines], w_end[lines]), SHINGLE)
            values = bands_of(grams, of, len(lines), bands, width).view(np.int64)
            sizes, has = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
            sizes[lines], has[lines] = np.bincount(of, minlength=len(lines)), bands
            chars = np.r_[0, np.cumsum((data & 0xC0) != 0x80)]
            base = chars[offsets[texts]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(docs[row + texts[used]]), pa.array(keys[row + texts[used]]), pa.array((chars[starts] - base)[used]), pa.array((chars[ends] - base)[used]),
                 pa.array(counts[used]), pa.array(line[used]), pa.array(banded[used]), pa.array(node[used].view(np.int64)), pa.array(sizes[used]),
                 pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(has[used])].astype(np.int32)), pa.array(values.ravel()))],
                ["doc", "key", "first", "behind", "n_words", "line", "banded", "node", "n_shingles", "bands"],
            )


def _line_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Text of the wanted places (node, first, behind) of each document."""
    for batch in batches:
        nodes, texts = [], []
        for text, wanted in zip(batch.column("text").to_pylist(), batch.column("wanted").to_pylist(), strict=True):
            for w in wanted:
                nodes.append(w["node"])
                texts.append(text[w["first"] : w["behind"]])
        yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(texts, pa.string())], ["doc_id", "text"])


def repeated_passages(docs: DataFrame) -> DataFrame:
    """One row per place of each cluster of two or more: ``doc_id, start, end`` (code points),
    ``n_words, whole_line, cluster_id, removed``."""
    # key tells rows without a doc_id, or that repeat one, apart by their text
    docs = docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LAST)).alias("doc"), "text", F.xxhash64("text").alias("key"))
    again = stored(docs.groupBy("doc").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("doc"))
    repeat = not again.isEmpty()
    found = stored(docs.mapInArrow(_units, _UNIT))
    nodes = stored(
        found.groupBy("node").agg(
            F.count(F.lit(1)).alias("n"), F.min("doc").alias("doc"), F.max("banded").alias("banded"), F.max("n_shingles").alias("n_shingles")
        ).filter("n > 1 or banded")
    )
    # near ones: lines that collide in a band, all collisions of a band linked to the least
    banded = found.filter("banded").select("node", F.explode("bands").alias("band"))
    meeting = stored(
        banded.groupBy("band").agg(F.min("node").alias("lead"), F.max("node").alias("last")).filter("lead < last").drop("last")
    )
    few = small(meeting)
    met = (banded.join(F.broadcast(meeting), "band") if few else banded.distinct().join(meeting, "band")).filter("node <> lead")
    groups = stored(components(met.select(F.col("node").alias("a"), F.col("lead").alias("b")).distinct()))
    sized = join_checked(nodes.select("node", "n_shingles", "doc"), groups, ["node"]).withColumnRenamed("component", "c")
    # the text of each, from its first document
    places = join_checked(found.filter("banded").select("node", "doc", "key", "first", "behind"), sized.select("node", "doc"), ["node", "doc"])
    places = places.groupBy("doc", "node").agg(F.min(F.struct("first", "behind", "key")).alias("p"))
    wanted = stored(places.groupBy("doc", "p.key").agg(F.collect_list(F.struct("node", "p.first", "p.behind")).alias("wanted")))
    items = wanted.agg(F.coalesce(F.sum(F.size("wanted")), F.lit(0))).first()[0]
    cut = docs.join(F.broadcast(wanted) if items <= 1_000_000 else wanted, ["doc", "key"])
    texts = cut.select("text", "wanted").mapInArrow(_line_texts, "doc_id bigint, text string")
    texts = stored(texts.dropDuplicates(["doc_id"]) if repeat else texts)
    sized = finer_groups(texts, sized.select(F.col("node").alias("doc_id"), "n_shingles", "c"), SHINGLE, NUM, DEN)
    near = stored(components(links_within(texts, sized, SHINGLE, NUM, DEN)))

    repeated = nodes.filter("n > 1").select("node").unionByName(near.select("node")).distinct()
    named = stored(
        join_checked(repeated, near, ["node"], "left").select("node", F.coalesce("component", "node").alias("cluster_id"))
    )
    places = stored(
        join_checked(found.select("doc", "first", "behind", "n_words", "line", "node"), named, ["node"])
        .select("doc", "first", "behind", "line", "cluster_id", "n_words")
    )
    # the same place twice: only of documents with several rows
    if repeat:
        once = join_checked(places, again, ["doc"], "left_semi")
        once = once.groupBy("doc", "first", "behind", "line", "cluster_id").agg(F.max("n_words").alias("n_words"))
        places = stored(join_checked(places, again, ["doc"], "left_anti").unionByName(once))
    # the first place as one number, which partial sums can hold
    place = F.col("doc").cast("decimal(19,0)") * F.lit(_PLACES) + F.col("first").cast("decimal(16,0)")
    kept = places.groupBy("cluster_id").agg(F.min(place).alias("kept"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    kept_first = F.pmod("kept", F.lit(_PLACES))
    kept = kept.select(
        "cluster_id", kept_first.cast("bigint").alias("kept_first"), ((F.col("kept") - kept_first) / F.lit(_PLACES)).cast("bigint").alias("kept_doc")
    )
    whole = join_checked(places, stored(kept), ["cluster_id"])
    return whole.select(
        F.when(F.col("doc") != LAST, F.col("doc")).alias("doc_id"), F.col("first").alias("start"), F.col("behind").alias("end"),
        "n_words", F.col("line").alias("whole_line"), "cluster_id",
        ((F.col("doc") != F.col("kept_doc")) | (F.col("first") != F.col("kept_first"))).alias("removed"),
    )
