"""Benchmark decontamination by winnowing.

Both sides keep, of every ``WINDOW - GRAM + 1`` consecutive k-grams of words, the one
with the least hash. Texts that share ``WINDOW`` words therefore share a kept k-gram at
the same place of that span, so looking up the kept k-grams alone finds every shared
span. A match is extended: each window of ``WINDOW`` words around it is looked up among
the windows of the benchmark, by two hashes made of its words' 64-bit hashes. An item with fewer words than a window is a
window of its own length n; every n-gram of the documents is looked up for it, which is
winnowing with a guarantee of n.

Scale: a benchmark of at most ``MOST_BYTES`` of text, as counted, is broadcast and its fingerprints are probed inside one scan of the
corpus, which is not shuffled; a worker builds the index once. With a larger benchmark the kept k-grams of both sides are
tables and are joined: documents that share one with the benchmark, and no others, then give their windows, which are joined with
its windows. K-grams of very many places are dealt over several tasks. Both ways give the same rows.

Null or empty documents have no words and get zeros; items without words match nothing,
items without an id are left out, repeated ids count as one item. Rows that repeat each
get their own result. Other columns, whatever their names, are passed by.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from webloom.llm.storage import BROADCAST_ROWS, stored
from webloom.llm.words import ALNUM, Words, gram_hashes, text_slices, within_rows
from webloom.session import checked_lookup, lookup_join

WINDOW = 10  # words
GRAM = 5
MOST_BYTES = 64 << 20
LEAK = "_leak"
CHECK = 1  # seed of the second half of a window's hash

SPAN = StructType([StructField("first", LongType()), StructField("last", LongType())])
FOUND = StructType(
    [StructField("spans", ArrayType(SPAN)), StructField("items", ArrayType(StringType())), StructField("words", LongType())]
)


def kept_grams(hashes: np.ndarray, rows: np.ndarray, window: int = WINDOW, k: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and positions of the k-grams that winnowing keeps, text by text."""
    grams = gram_hashes(hashes, k)
    picked = window - k + 1
    n = len(grams) - picked + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    least, at = grams[:n].copy(), np.arange(n)
    for j in range(1, picked):
        other = grams[j : j + n]
        lower = other <= least
        least[lower] = other[lower]
        at[lower] = np.flatnonzero(lower) + j
    at = np.unique(at[within_rows(rows, window)[:n]])
    return grams[at], at


class Index:
    """Windows of a block of the benchmark, by length, with the items that hold them."""

    def __init__(self, ids: list[str], texts: list[str]):
        parts, kept = [], []
        for first, n, data, offsets in text_slices(pa.array(texts, pa.large_string())):
            words = Words(data, offsets, ALNUM)
            hashes = words.hashes()
            for length in np.unique(np.minimum(words.counts, WINDOW)):
                if not length:
                    continue
                starts = within_rows(words.rows, length)
                if length < WINDOW:
                    starts &= (words.counts == length)[words.rows[: len(starts)]]
                else:
                    kept.append(kept_grams(hashes, words.rows)[0])
                at = np.flatnonzero(starts)
                parts.append(
                    (np.full(len(at), length), gram_hashes(hashes, length)[at],
                     gram_hashes(hashes, length, CHECK)[at], words.rows[at] + first)
                )
        self.ids = ids
        self.kept = np.unique(np.concatenate(kept)) if kept else np.zeros(0, np.uint64)
        self.tables: dict[int, tuple[np.ndarray, ...]] = {}
        if parts:
            lengths, windows, checks, owners = (np.concatenate(x) for x in zip(*parts, strict=True))
            for length in np.unique(lengths):
                own = lengths == length
                rows = np.unique(np.rec.fromarrays([windows[own], checks[own], owners[own]], names="w,c,o"))
                heads = np.flatnonzero(np.r_[True, (rows.w[1:] != rows.w[:-1]) | (rows.c[1:] != rows.c[:-1])])
                self.tables[int(length)] = (
                    rows.w[heads].copy(), rows.c[heads].copy(), np.r_[heads, len(rows)], rows.o.copy()
                )

    def find(self, hashes: np.ndarray, rows: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Yield (window length, positions of windows that occur, their number in the table)."""
        for length, (windows, checks, _, _) in self.tables.items():
            if length == WINDOW:
                grams, at = kept_grams(hashes, rows)
                at = at[_among(grams, self.kept)[1]]
                around = at[:, None] - np.arange(WINDOW - GRAM + 1)[None, :]
                at = np.unique(around[around >= 0])
                inside = within_rows(rows, WINDOW)
                at = at[at < len(inside)]
                at = at[inside[at]]
                found = _grams_at(hashes, at, WINDOW)
            else:
                at = np.flatnonzero(within_rows(rows, length))
                found = gram_hashes(hashes, length)[at]
            number, hit = _among(found, windows)
            number, at = number[hit], at[hit]
            sure = checks[number] == _grams_at(hashes, at, length, CHECK)
            # equal first halves with other second halves stand side by side
            for p in np.flatnonzero(~sure):
                check = _grams_at(hashes, at[p : p + 1], length, CHECK)[0]
                same = np.flatnonzero((windows == windows[number[p]]) & (checks == check))
                if len(same):
                    number[p], sure[p] = same[0], True
            yield length, at[sure], number[sure]


def _among(values: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.searchsorted(table, values)
    if not len(table):
        return at, np.zeros(len(values), bool)
    at = np.minimum(at, len(table) - 1)
    return at, table[at] == values


def _grams_at(hashes: np.ndarray, at: np.ndarray, k: int, seed: int = 0) -> np.ndarray:
    if not len(at):
        return np.zeros(0, np.uint64)
    return gram_hashes(hashes[at[:, None] + np.arange(k)[None, :]].T.reshape(k, -1), k, seed)[0]


def _probe(index: Index, column: pa.Array) -> list[pa.Array]:
    """Hit word spans, items and number of words of each text."""
    spans, items, counts = [], [], []
    for _, n, data, offsets in text_slices(column):
        words = Words(data, offsets, ALNUM)
        own_spans, own_items = [[] for _ in range(n)], [set() for _ in range(n)]
        hashes = words.hashes()
        for length, at, number in index.find(hashes, words.rows):
            _, _, heads, owners = index.tables[length]
            for p, w in zip(at.tolist(), number.tolist(), strict=True):
                row = words.rows[p]
                first = p - int(words.firsts[row])
                own_spans[row].append({"first": first, "last": first + length})
                own_items[row].update(index.ids[o] for o in owners[heads[w] : heads[w + 1]])
        spans += own_spans
        items += [sorted(x) for x in own_items]
        counts += words.counts.tolist()
    return [
        pa.array(spans, pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))),
        pa.array(items, pa.list_(pa.string())),
        pa.array(counts, pa.int64()),
    ]


def _by_probes(docs: DataFrame, items: DataFrame, text: str) -> DataFrame:
    """The benchmark, counted to be small, probed inside the scan of the documents."""
    rows = items.collect()
    shared = docs.sparkSession.sparkContext.broadcast({"ids": [r.id for r in rows], "texts": [r.text for r in rows]})
    probed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(text).alias("probed"))

    def scan(batches):
        own = shared.value  # one per worker, so the index stays for its next tasks
        index = own.get("index") or own.setdefault("index", Index(own["ids"], own["texts"]))
        for batch in batches:
            found = pa.StructArray.from_arrays(_probe(index, batch.column("probed")), ["spans", "items", "words"])
            yield pa.RecordBatch.from_arrays([*batch.columns, found], [*batch.schema.names, "found"])

    schema = StructType([*probed.schema.fields, StructField("found", FOUND)])
    return probed.mapInArrow(scan, schema).select("row.*", F.col("found").alias(LEAK))


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``id, gram`` of the k-grams that winnowing keeps."""
    for batch in batches:
        ids = batch["id"]
        for first, _, data, offsets in text_slices(batch["text"]):
            words = Words(data, offsets, ALNUM)
            grams, at = kept_grams(words.hashes(), words.rows)
            yield pa.record_batch([pc.take(ids, pa.array(words.rows[at] + first)), pa.array(grams.view(np.int64))], ["id", "gram"])


def _windows(batches: Iterator[pa.RecordBatch], lengths: list[int] | None) -> Iterator[pa.RecordBatch]:
    """``id, n, w, c, first`` of windows: those of the lengths, or of an item its own."""
    for batch in batches:
        ids = batch["id"]
        for row, _, data, offsets in text_slices(batch["text"]):
            words = Words(data, offsets, ALNUM)
            hashes = words.hashes()
            for n in np.unique(np.minimum(words.counts, WINDOW)) if lengths is None else lengths:
                starts = within_rows(words.rows, n) if n else np.zeros(0, bool)
                if lengths is None and n < WINDOW:
                    starts &= (words.counts == n)[words.rows[: len(starts)]]
                at = np.flatnonzero(starts)
                of = words.rows[at]
                yield pa.record_batch(
                    [pc.take(ids, pa.array(of + row)), pa.array(np.full(len(at), n, np.int32)),
                     pa.array(gram_hashes(hashes, int(n))[at].view(np.int64)) if n else pa.array([], pa.int64()),
                     pa.array(gram_hashes(hashes, int(n), CHECK)[at].view(np.int64)) if n else pa.array([], pa.int64()),
                     pa.array(at - words.firsts[of])],
                    ["id", "n", "w", "c", "first"],
                )


def _by_joins(docs: DataFrame, items: DataFrame, text: str) -> DataFrame:
    """Fingerprints and windows of both sides as tables, joined."""
    schema = "n int, w bigint, c bigint, first bigint"
    own = [F.col(f"`{c}`") for c in docs.columns]
    rows = stored(docs.select(F.struct(*own).alias("row"), F.col(text).alias("text"), F.monotonically_increasing_id().alias("id")))
    kept = stored(items.mapInArrow(_kept, "id string, gram bigint").select("gram").distinct().withColumn("known", F.lit(True)))
    windows = stored(items.mapInArrow(lambda b: _windows(b, None), f"id string, {schema}").select("n", "w", "c", F.col("id").alias("item")).distinct())
    short = sorted(r.n for r in windows.filter(F.col("n") < WINDOW).select("n").distinct().collect())  # at most WINDOW - 1
    texts = rows.select("id", "text")
    grams = texts.mapInArrow(_kept, "id bigint, gram bigint")
    sharing = lookup_join(grams, checked_lookup(kept, BROADCAST_ROWS), "gram").filter("known").select("id").distinct()
    near = texts.join(stored(sharing), "id", "left_semi")
    found = near.mapInArrow(lambda b: _windows(b, [WINDOW]), f"id bigint, {schema}")
    if short:
        found = found.unionByName(texts.mapInArrow(lambda b: _windows(b, short), f"id bigint, {schema}"))
    hits = stored(found.join(windows, ["n", "w", "c"]).select("id", "first", (F.col("first") + F.col("n")).alias("last"), "item"))
    spans = hits.select("id", "first", "last").distinct().groupBy("id").agg(F.collect_list(F.struct("first", "last")).alias("spans"))
    named = hits.select("id", "item").distinct().groupBy("id").agg(F.sort_array(F.collect_list("item")).alias("items"))
    words = F.coalesce(F.regexp_count("text", F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")), F.lit(0)).cast("bigint")
    joined = rows.withColumn("words", words).join(spans.join(named, "id"), "id", "left")
    none = [F.array().cast(FOUND[name].dataType) for name in ("spans", "items")]
    leak = F.struct(F.coalesce("spans", none[0]).alias("spans"), F.coalesce("items", none[1]).alias("items"), "words")
    return joined.select("row.*", leak.alias(LEAK))


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item_text: str = "text", item_id: str = "item_id",
    most_bytes: int = MOST_BYTES,
) -> DataFrame:
    """``docs`` with the column ``LEAK``: hit word spans (first, behind the last), items, number of words.

    Spans may overlap. Every column of ``docs`` is kept.
    """
    usable = benchmark.filter(F.col(item_id).isNotNull() & (F.length(item_text) > 0))
    items = usable.select(F.col(item_id).cast("string").alias("id"), F.col(item_text).alias("text")).distinct()
    size = F.sum(F.octet_length("text") + F.octet_length("id"))
    small = (items.agg(F.coalesce(size, F.lit(0))).first()[0]) <= most_bytes
    return _by_probes(docs, items, text) if small else _by_joins(docs, items, text)


def hit_words(spans) -> F.Column:
    """Number of words inside any of the spans."""
    ordered = F.array_sort(spans)
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("behind"))
    return F.aggregate(
        ordered, start,
        lambda a, s: F.struct(
            (a["n"] + F.greatest(F.lit(0).cast("long"), s["last"] - F.greatest(s["first"], a["behind"]))).alias("n"),
            F.greatest(a["behind"], s["last"]).alias("behind"),
        ),
        lambda a: a["n"],
    )


def leak_report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document: its words, hit words and items."""
    found = find_leaks(docs.select("doc_id", "text"), benchmark)
    return found.select(
        "doc_id",
        F.col(f"{LEAK}.words").alias("n_words"),
        hit_words(F.col(f"{LEAK}.spans")).alias("n_hit"),
        F.size(f"{LEAK}.items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort(f"{LEAK}.items"), ",").cast("binary"), 256).alias("items_sha256"),
        (F.size(f"{LEAK}.spans") > 0).alias("contaminated"),
    )


def drop_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Documents without any window of the benchmark, with all their columns."""
    return find_leaks(docs, benchmark).filter(F.size(f"{LEAK}.spans") == 0).drop(LEAK)


SQL = """
WITH w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM benchmark WHERE item_id IS NOT NULL),
lengths AS (SELECT DISTINCT least(len(words), 10) AS n FROM b WHERE len(words) > 0),
bw AS (SELECT DISTINCT item_id, n, array_to_string(words[p : p + n - 1], ' ') AS gram
    FROM (SELECT item_id, words, least(len(words), 10) AS n, unnest(range(1, len(words) - least(len(words), 10) + 2)) AS p FROM b WHERE len(words) > 0)),
dw AS (SELECT doc_id, n, p, array_to_string(words[p : p + n - 1], ' ') AS gram
    FROM (SELECT doc_id, words, n, unnest(range(1, greatest(len(words) - n + 2, 1))) AS p FROM w, lengths)),
hits AS (SELECT doc_id, p, n, item_id FROM dw JOIN bw USING (n, gram)),
covered AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(p, p + n)) AS q FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM hits) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(w.words) AS BIGINT) AS n_words, CAST(coalesce(c.n_hit, 0) AS BIGINT) AS n_hit,
    CAST(coalesce(i.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(i.ids, '')) AS items_sha256, c.n_hit IS NOT NULL AS contaminated
FROM w LEFT JOIN covered c USING (doc_id) LEFT JOIN items i USING (doc_id)
"""
