"""The index in a shared folder: segments, versions that list them, and lookups that open few files."""

from __future__ import annotations

import json
import math
import time
import uuid
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from webloom.operators.audit import audit_delta, audit_index
from webloom.operators.ledger import pending_files, seed_ledger
from webloom.plans.index import Index
from webloom.sources.folder import SharedFolder

ROWS_PER_FILE = 1_000_000
BLOCK = 32_768  # rows of a bitmap
BITMAPS_BROADCAST = 10_000  # of 4 KB each
KEYS_BROADCAST, KEY_BYTES_BROADCAST = 1_000_000, 64 << 20
FAN = 4  # segments of a size that are merged into one of the next

# Schema and order of each table. Files are range-partitioned and sorted by the order, so each holds a range of
# its first column and a frequent key spreads over several files.
TABLES = {
    "websites": ("url string, title string, description string, word_count int", ["url"]),
    "keyword_parts": ("file_id string, word string, documents_containing_word bigint", ["word", "file_id"]),
    "postings": ("word string, url string, keyword_occurrences int", ["word", "url"]),
    "links": ("source_url string, target_website string", ["target_website", "source_url"]),
    "links_by_source": ("source_url string, target_website string", ["source_url", "target_website"]),
    "outlinks": ("source_url string, outlinks bigint", ["source_url"]),
    "keywords": ("word string, documents_containing_word bigint", ["documents_containing_word", "word"]),
    "inlinks": ("target_website string, inlinks bigint", ["inlinks", "target_website"]),
    "files": ("file_name string, processed boolean", ["file_name"]),
    "archives": ("file_id string", ["file_id"]),
    "failed": ("file_name string, reason string", ["file_name"]),
}
PAGE_KEYS = {"websites": "url", "postings": "url", "links": "source_url", "links_by_source": "source_url", "outlinks": "source_url"}
PLACE = ("_segment", "_file", "_row")
DELETES = "table string, segment string, file string, block bigint, bits binary, n bigint"
REPORT = "version long, records_read long, records_matching long, records_damaged long, pages_valid long, pages_added long, files_left long"


class Conflict(Exception):
    """What a change was made from is no longer there."""


class IndexStore:
    """Segments of the index and the versions that list them.

    A batch becomes a segment: every table of it in its stored order, with the key range of every file: as part of
    the version for a table of one file, and as a manifest beside the table for others. A version is one small file that names its segments; it is created under the next number if nobody
    else has taken it, so of two writers one commits and the other works out what depends on the version anew
    and tries again. Nothing that a version names is ever written over, and an attempt that fails leaves no version.

    Rows of earlier segments that a batch replaces are marked in bitmaps of row positions per file and block of
    rows. Reading a segment without such rows is a plain scan; others are compared with their bitmaps, block by
    block. Words with their document frequency and targets with their number of links are kept as totals: a
    batch's signed changes are added to the totals of the words and targets it touches, and no others.

    After a commit, ``FAN`` segments of one size class are merged into one of the next, so a row is written again
    a number of times that grows with the logarithm of the index, and so do the segments. ``clean`` deletes what
    no current or leased version names.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.folder = SharedFolder(spark, self.root)

    # --- versions ---------------------------------------------------------------------------

    def current(self) -> dict | None:
        """The last version, None for a new store."""
        names = self.folder.entries("versions")
        return json.loads(self.folder.read(f"versions/{max(names)}")) if names else None

    def _commit(self, change: Callable[[dict | None], dict | None], note: str = "") -> int:
        """Make the next version of what ``change`` gives for the current one, anew whenever another writer was first."""
        while True:
            head = self.current()
            if note and self.has(note, head):
                return head["version"]
            made = change(head)
            if made is None:
                return head["version"] if head else 0
            number = head["version"] + 1 if head else 1
            notes = dict(head["notes"]) if head else {}
            if note:
                notes[note.rpartition("-")[0]] = note
            if self.folder.create(f"versions/{number:010}.json", json.dumps(made | {"version": number, "notes": notes}, indent=1)):
                return number

    def has(self, note: str, head: dict | None = None) -> bool:
        """Whether a batch of this note is the last that its stream has committed."""
        head = head or self.current()
        return bool(head) and head["notes"].get(note.rpartition("-")[0]) == note

    # --- reading ------------------------------------------------------------------------------

    def _path(self, segment: dict, table: str) -> str:
        return f"{self.root}/{segment['paths'][table]}"

    def _scan(self, table: str, paths: list[str], positions: bool) -> DataFrame:
        rows = self.spark.read.schema(TABLES[table][0]).parquet(*paths)
        if positions:
            segment = F.regexp_extract("_metadata.file_path", r"/segments/([0-9a-f]+)/", 1)
            rows = rows.withColumns({"_segment": segment, "_file": F.col("_metadata.file_name"), "_row": F.col("_metadata.row_index")})
        return rows

    def _live(self, head: dict, table: str, segments: list[dict] | None = None, positions: bool = False, files: set | None = None) -> DataFrame:
        """Rows of a table that no later batch has replaced, of some files only if they are named."""
        segments = head["segments"] if segments is None else segments
        frames = []
        for dead in (False, True):
            chosen = [s for s in segments if table in s["paths"] and bool(s["dead"].get(table)) == dead]
            folders = {s["paths"][table] for s in chosen}
            if files is None:
                paths = [self._path(s, table) for s in chosen]
            else:
                paths = [f"{self.root}/{f}" for f in sorted(files) if f.rpartition("/")[0] in folders]
            if paths and dead:
                marked = self._without_replaced(self._scan(table, paths, True), head, table, chosen)
                frames.append(marked if positions else marked.drop(*PLACE))
            elif paths:
                frames.append(self._scan(table, paths, positions))
        if not frames:
            schema = TABLES[table][0] + (", _segment string, _file string, _row bigint" if positions else "")
            return self.spark.createDataFrame([], schema)
        return reduce(DataFrame.unionByName, frames)

    def _without_replaced(self, rows: DataFrame, head: dict, table: str, segments: list[dict]) -> DataFrame:
        paths = [f"{self.root}/{d['path']}" for d in head["deletes"]]
        ids = [s["id"] for s in segments]
        marks = self.spark.read.schema(DELETES).parquet(*paths).filter((F.col("table") == table) & F.col("segment").isin(ids))
        marks = marks.groupBy(F.col("file").alias("_file"), F.col("block").alias("_block")).agg(F.bitmap_or_agg("bits").alias("_bits"))
        # a bitmap has a replaced row at least, and a block at most as many as it has rows
        most = sum(min(s["dead"][table], s["rows"][table] // BLOCK + 1 + s["files"][table]) for s in segments)
        marked = rows.withColumn("_block", F.floor(F.col("_row") / BLOCK)).join(
            F.broadcast(marks) if most <= BITMAPS_BROADCAST else marks, ["_file", "_block"], "left"
        )
        return marked.filter(F.col("_bits").isNull() | ~_bit(F.col("_bits"), F.col("_row") % BLOCK)).drop("_bits", "_block")

    def read(self, version: dict | None = None) -> Index | None:
        """The index of the current version, or of one that ``reading`` holds."""
        head = version or self.current()
        if head is None:
            return None
        tables = {name: self._live(head, name) for name in ("websites", "keyword_parts", "postings", "links")}
        return Index(**tables, totals=self._live(head, "keywords"))

    @contextmanager
    def reading(self, seconds: int = 24 * 3600) -> Iterator[dict]:
        """Hold the current version: ``clean`` leaves its files until this ends or its time is over."""
        head = self.current()
        name = f"leases/{uuid.uuid4().hex}.json"
        self.folder.create(name, json.dumps({"version": head["version"], "until": time.time() + seconds}))
        try:
            yield head
        finally:
            self.folder.remove(name)

    def files(self) -> DataFrame | None:
        """The ledger; a file stays processed once any batch has marked it."""
        head = self.current()
        if head is None:
            return None
        return self._live(head, "files").groupBy("file_name").agg(F.bool_or("processed").alias("processed"))

    # --- lookups ------------------------------------------------------------------------------

    def files_between(self, table: str, ranges: list[tuple], head: dict | None = None) -> set[str]:
        """Files of a table that can hold a key of one of the ranges ``(low, high)``; None is no bound."""
        head, found, paths = head or self.current(), set(), []
        for s in head["segments"]:
            if table in s["manifests"]:
                paths.append(f"{self.root}/{s['manifests'][table]}")
            elif table in s["ranges"]:
                file, least, most = s["ranges"][table]
                if least is not None and any((low is None or low <= most) and (high is None or least <= high) for low, high in ranges):
                    found.add(file)
        if paths and ranges:
            meets = [
                (F.lit(True) if low is None else F.col("high") >= low) & (F.lit(True) if high is None else F.col("low") <= high)
                for low, high in ranges
            ]
            kind = dict(f.split() for f in TABLES[table][0].split(", "))[TABLES[table][1][0]]
            manifests = self.spark.read.schema(f"file string, low {kind}, high {kind}").parquet(*paths)
            found |= {r[0] for r in manifests.filter(reduce(Column.__or__, meets)).select("file").collect()}
        return found

    def files_with(self, table: str, keys: list[str], head: dict | None = None) -> set[str]:
        """Files of a table that can hold one of the keys of its order."""
        return self.files_between(table, [(key, key) for key in keys], head)

    def _by_key(self, table: str, keys: list[str], head: dict | None = None) -> DataFrame:
        head = head or self.current()
        rows = self._live(head, table, files=self.files_with(table, keys, head))
        return rows.filter(F.col(TABLES[table][1][0]).isin(keys))

    def postings_of(self, words: list[str], min_occurrences: int = 1) -> DataFrame:
        """Postings of some words, from the files whose range holds one of them."""
        return self._by_key("postings", words).filter(F.col("keyword_occurrences") >= min_occurrences)

    def links_from(self, urls: list[str]) -> DataFrame:
        return self._by_key("links_by_source", urls)

    def links_to(self, targets: list[str]) -> DataFrame:
        return self._by_key("links", targets)

    def _between(self, table: str, low: int, high: int | None, head: dict) -> DataFrame:
        """Totals in a range, from the files whose range meets it."""
        rows = self._live(head, table, files=self.files_between(table, [(low, high)], head))
        value = F.col(TABLES[table][1][0])
        return rows.filter((value >= low) if high is None else value.between(low, high))

    def keywords_by_df(self, low: int, high: int) -> DataFrame:
        return self._between("keywords", low, high, self.current())

    def top_keywords(self, count: int) -> DataFrame:
        """The ``count`` most frequent words. The number of words by power of two of their frequency is part of
        the version and tells from which frequency on there are enough, so only files from there on are read."""
        head = self.current()
        enough, low = 0, 0
        for power in sorted(map(int, head["frequencies"]), reverse=True):
            enough += head["frequencies"][str(power)]
            if enough >= count:
                low = 1 << power
                break
        rows = self._between("keywords", low, None, head)
        return rows.orderBy(F.desc("documents_containing_word"), "word").limit(count)

    def inlink_counts(self) -> DataFrame:
        return self._live(self.current(), "inlinks")

    def outlink_counts(self) -> DataFrame:
        return self._live(self.current(), "outlinks")

    # --- writing ------------------------------------------------------------------------------

    def append(
        self, batch: Index, files: DataFrame, note: str = "", archives: DataFrame | None = None, failed: DataFrame | None = None
    ) -> int:
        """Add a batch: its pages replace stored ones, its archives' counts too.

        ``archives``: the ``file_id`` of all archives in the batch, also of those without a word; ``failed``: the
        ``(file_name, reason)`` of those that could not be read to their end.
        """
        segment = self._new_segment(batch, files, archives, failed)
        return self._commit(lambda head: self._with(head, segment) if head else self._only(segment), note)

    def publish(self, index: Index, files: DataFrame, note: str = "", archives: DataFrame | None = None) -> int:
        """Store a whole index in place of all that is there."""
        segment = self._new_segment(index, files, archives)
        return self._commit(lambda _: self._only(segment), note)

    def _write(self, segment: dict, tables: dict[str, DataFrame], rows: int | None = None, attempt: str = "") -> None:
        """Write tables in their stored order, all at once; ``rows`` is an upper bound on the rows of each if it is known.

        What a table holds is noted in the segment: rows, files, bytes of its first column, and the range of that column in
        each file. For a table of one file that is counted while it is written; others get a manifest.
        """
        def write(name: str) -> None:
            schema, order = TABLES[name]
            table = tables[name].select([F.col(f.split()[0]).cast(f.split()[1]) for f in schema.split(", ")])
            parts = max(1, -(-(table.count() if rows is None else rows) // ROWS_PER_FILE))
            path = segment["paths"][name] = f"segments/{segment['id']}/{name}{attempt}"
            key, counted = F.col(order[0]), Observation()
            dealt = table.repartitionByRange(parts, *order) if parts > 1 else table.repartition(1)
            dealt.sortWithinPartitions(*order).observe(
                counted, F.count(F.lit(1)).alias("n"), F.min(key).alias("low"), F.max(key).alias("high"),
                F.coalesce(F.sum(F.octet_length(key.cast("string"))), F.lit(0)).alias("bytes"),
            ).write.mode("overwrite").parquet(f"{self.root}/{path}")
            found = {"n": 0, "low": None, "high": None, "bytes": 0} | observed(counted)
            files = [f for f in self.folder.entries(path) if f.endswith(".parquet")]
            segment["rows"][name], segment["files"][name], segment["bytes"][name] = found["n"], len(files), found["bytes"]
            if len(files) == 1:
                segment["ranges"][name] = [f"{path}/{files[0]}", found["low"], found["high"]]
            elif files:
                segment["manifests"][name] = self._manifest_of(name, path)

        at_once(write, tables)

    def _manifest_of(self, name: str, path: str) -> str:
        """A table of the key range of every file of a table."""
        key = TABLES[name][1][0]
        files = self._scan(name, [f"{self.root}/{path}"], False).groupBy(
            F.concat(F.lit(path + "/"), F.col("_metadata.file_name")).alias("file")
        ).agg(F.min(key).alias("low"), F.max(key).alias("high"))
        files.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/{path}-manifest")
        return f"{path}-manifest"

    def _new_segment(self, batch: Index, files: DataFrame, archives: DataFrame | None, failed: DataFrame | None = None) -> dict:
        """Tables of a batch that do not depend on what is stored."""
        segment = _blank()
        archives = (batch.keyword_parts if archives is None else archives).select("file_id").distinct()
        self._write(segment, {
            "websites": batch.websites, "keyword_parts": batch.keyword_parts, "postings": batch.postings, "links": batch.links,
            "files": files, "archives": archives,
        } | ({} if failed is None else {"failed": failed}), batch.rows)
        links = self._scan("links", [self._path(segment, "links")], False)
        outlinks = links.groupBy("source_url").agg(F.count(F.lit(1)).alias("outlinks"))
        self._write(segment, {"links_by_source": links, "outlinks": outlinks}, segment["rows"]["links"])
        return segment

    def _only(self, segment: dict) -> dict:
        """A version of one segment."""
        segment = _copy(segment)
        parts, links = (self._scan(t, [self._path(segment, t)], False) for t in ("keyword_parts", "links"))
        tables = {
            "keywords": parts.groupBy("word").agg(F.sum("documents_containing_word").alias("documents_containing_word")),
            "inlinks": links.filter("target_website IS NOT NULL").groupBy("target_website").agg(F.count(F.lit(1)).alias("inlinks")),
        }
        self._write(segment, tables, max(segment["rows"]["keyword_parts"], segment["rows"]["links"]), f"-{uuid.uuid4().hex[:8]}")
        words = self._scan("keywords", [self._path(segment, "keywords")], False)
        counts = words.groupBy(_power("documents_containing_word").alias("power")).count().collect()
        return {"segments": [segment], "deletes": [], "frequencies": {str(r["power"]): r["count"] for r in counts}}

    def _with(self, head: dict, segment: dict) -> dict:
        """The version after ``head`` with one more segment: totals, and bitmaps of the rows that are replaced."""
        segment = _copy(segment)
        attempt = uuid.uuid4().hex[:8]
        folder = f"segments/{segment['id']}/work-{attempt}"

        def kept(name: str, rows: DataFrame) -> tuple[DataFrame, int]:
            """Rows in a table of their own, and how many they are."""
            counted = Observation()
            rows.observe(counted, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(f"{self.root}/{folder}/{name}")
            return self.spark.read.schema(rows.schema).parquet(f"{self.root}/{folder}/{name}"), observed(counted).get("n", 0)

        def few(rows: int, size: int) -> bool:
            return rows <= KEYS_BROADCAST and size <= KEY_BYTES_BROADCAST

        def of(rows: DataFrame, keys: DataFrame, key: str, small: bool) -> DataFrame:
            """Rows with one of the keys, which are broadcast if they are few."""
            return rows.join(F.broadcast(keys) if small else keys, key, "left_semi")

        def replaced(table: str, key: str) -> tuple[DataFrame, int]:
            """Rows of a table whose key the batch brings anew."""
            small = few(segment["rows"][table], segment["bytes"][table])
            return kept(table, of(self._live(head, table, positions=True), own[table].select(key), key, small).select(key, *PLACE))

        own = {t: self._scan(t, [self._path(segment, t)], False) for t in segment["paths"]}
        (urls, n_urls), (known, n_known) = at_once(lambda pair: replaced(*pair), [("websites", "url"), ("archives", "file_id")])
        gone = ({"archives": known} if n_known else {}) | ({"websites": urls} if n_urls else {})
        wanted = {}
        for table, key in PAGE_KEYS.items() if n_urls else ():
            if table == "websites":
                continue
            keys, small = urls.select(F.col("url").alias(key)), few(n_urls, segment["bytes"]["websites"])
            rows = of(self._live(head, table, positions=True), keys, key, small)
            wanted[table] = rows.select(*(["target_website"] if table == "links" else []), *PLACE)
        if n_known:
            rows = of(self._live(head, "keyword_parts", positions=True), known.select("file_id"), "file_id", few(n_known, segment["bytes"]["archives"]))
            wanted["keyword_parts"] = rows.select("word", "documents_containing_word", *PLACE)
        gone |= dict(zip(wanted, (rows for rows, _ in at_once(lambda name: kept(f"gone_{name}", wanted[name]), wanted))))

        one = F.lit(1).cast("bigint").alias("inlinks")
        changes = {
            "keywords": ("word", "documents_containing_word", own["keyword_parts"], gone.get("keyword_parts"), "keyword_parts"),
            "inlinks": ("target_website", "inlinks", own["links"].select("target_website", one),
                        gone["links"].select("target_website", one) if "links" in gone else None, "links"),
        }

        def add_up(name: str) -> DataFrame:
            key, value, new, old, source = changes[name]
            signed = new.select(key, value)
            if old is not None:
                signed = signed.unionByName(old.select(key, (-F.col(value)).alias(value)))
            delta = signed.filter(F.col(key).isNotNull()).groupBy(key).agg(F.sum(value).alias("_delta"))
            before = self._live(head, name, positions=True).withColumnRenamed(value, "_before")
            if few(segment["rows"][source], segment["bytes"][source]) and old is None:
                before = of(before, delta.select(key), key, True)
            joined = delta.join(before, key, "left").withColumn(value, F.col("_delta") + F.coalesce("_before", F.lit(0)))
            return kept(f"totals_{name}", joined)[0]

        totals = dict(zip(changes, at_once(add_up, changes)))
        gone |= {n: t.filter("_file IS NOT NULL") for n, t in totals.items()}
        deletes = f"segments/{segment['id']}/deletes-{attempt}"

        def write_totals() -> None:
            live = {n: t.filter(F.col(changes[n][1]) > 0) for n, t in totals.items()}
            self._write(segment, live, max(segment["rows"]["keyword_parts"], segment["rows"]["links"]), f"-{attempt}")

        def mark() -> list:
            marks = [rows.select(
                F.lit(n).alias("table"), F.col("_segment").alias("segment"), F.col("_file").alias("file"), F.col("_row").alias("row")
            ) for n, rows in gone.items()]
            block = F.floor(F.col("row") / BLOCK).alias("block")
            marks = reduce(DataFrame.unionByName, marks).groupBy("table", "segment", "file", block).agg(
                F.bitmap_construct_agg(F.col("row") % BLOCK).alias("bits"), F.count(F.lit(1)).alias("n")
            )
            marks.write.mode("overwrite").parquet(f"{self.root}/{deletes}")
            marks = self.spark.read.schema(DELETES).parquet(f"{self.root}/{deletes}")
            return marks.groupBy("segment", "table").agg(F.sum("n").alias("n")).collect()

        def count_powers() -> list:
            now, before = F.col("documents_containing_word"), F.col("_before")
            both = F.array(F.struct(now.alias("v"), F.lit(1).alias("n")), F.struct(before.alias("v"), F.lit(-1).alias("n")))
            moved = totals["keywords"].select(F.explode(both).alias("x")).filter("x.v > 0")
            return moved.groupBy(_power("x.v").alias("power")).agg(F.sum("x.n").alias("n")).collect()

        _, dead, moved = at_once(lambda run: run(), [write_totals, mark, count_powers])
        frequencies = {**head["frequencies"]}
        for r in moved:
            frequencies[str(r["power"])] = frequencies.get(str(r["power"]), 0) + r["n"]
        segments = [_copy(s) for s in head["segments"]]
        for s in segments:
            for r in dead:
                if r["segment"] == s["id"]:
                    s["dead"][r["table"]] = s["dead"].get(r["table"], 0) + r["n"]
        marked = {"path": deletes, "segments": sorted({r["segment"] for r in dead})}
        self.folder.remove(folder)
        return {
            "segments": [*segments, segment], "deletes": [*head["deletes"], *([marked] if dead else [])],
            "frequencies": {p: n for p, n in frequencies.items() if n},
        }

    # --- merging and cleaning -------------------------------------------------------------------

    @staticmethod
    def size_class(segment: dict) -> int:
        """Power of ``FAN`` of a segment's live postings and pages, in units of a file's rows over 64."""
        live = sum(segment["rows"][t] - segment["dead"].get(t, 0) for t in ("postings", "websites"))
        return max(0, math.floor(math.log(max(live, 1) * 64 / ROWS_PER_FILE, FAN)))

    def merge_due(self) -> int:
        """Merge segments as long as ``FAN`` of a class are there. Returns how many merges were done."""
        merges = 0
        while True:
            classes: dict[int, list[dict]] = {}
            for s in (self.current() or {"segments": []})["segments"]:
                classes.setdefault(self.size_class(s), []).append(s)
            due = next((group for _, group in sorted(classes.items()) if len(group) >= FAN), None)
            if not due:
                return merges
            try:
                self._merge([s["id"] for s in due[:FAN]])
            except Conflict:
                continue
            merges += 1

    def compact(self) -> int:
        """Merge everything into one segment."""
        while True:
            try:
                return self._merge([s["id"] for s in self.current()["segments"]])
            except Conflict:
                continue

    def _merge(self, ids: list[str]) -> int:
        """Live rows of some segments as one. A batch that has replaced rows of theirs in the meantime makes it a conflict."""
        base = self.current()
        chosen = [s for s in base["segments"] if s["id"] in ids]
        merged = _blank()
        rows = max(sum(s["rows"].get(t, 0) - s["dead"].get(t, 0) for s in chosen) for t in TABLES)
        self._write(merged, {t: self._live(base, t, chosen) for t in TABLES if any(t in s["paths"] for s in chosen)}, rows)

        # the bitmaps of the segments that stay, as one table
        left = [s["id"] for s in base["segments"] if s["id"] not in ids and s["dead"]]
        folded = []
        if left and base["deletes"]:
            path = f"segments/{merged['id']}/deletes"
            marks = self.spark.read.schema(DELETES).parquet(*[f"{self.root}/{d['path']}" for d in base["deletes"]])
            marks = marks.filter(F.col("segment").isin(left)).groupBy("table", "segment", "file", "block").agg(F.bitmap_or_agg("bits").alias("bits"))
            marks.withColumn("n", F.bitmap_count("bits")).write.parquet(f"{self.root}/{path}")
            folded = [{"path": path, "segments": left}]

        def change(head: dict) -> dict:
            now = {s["id"]: s for s in head["segments"]}
            if any(s["id"] not in now or now[s["id"]]["dead"] != s["dead"] for s in chosen):
                raise Conflict("rows were replaced during a merge")
            segments = [s for s in head["segments"] if s["id"] not in ids] + [merged]
            return head | {"segments": segments, "deletes": folded + [d for d in head["deletes"] if d not in base["deletes"]]}

        return self._commit(change)

    def clean(self, grace: int = 3600) -> list[str]:
        """Delete folders that neither the current nor a leased version names, if they have not changed for ``grace``
        seconds: a writer that has not committed yet, or a reader without a lease, may still use younger ones."""
        names, now = sorted(self.folder.entries("versions")), time.time()
        if not names:
            return []
        keep = {names[-1]}
        for name in self.folder.entries("leases"):
            lease = json.loads(self.folder.read(f"leases/{name}"))
            if lease["until"] > now:
                keep.add(f"{lease['version']:010}.json")
            else:
                self.folder.remove(f"leases/{name}")
        used = set()
        for name in keep:
            version = json.loads(self.folder.read(f"versions/{name}"))
            used |= {path for s in version["segments"] for path in (*s["paths"].values(), *s["manifests"].values())} | {d["path"] for d in version["deletes"]}
        removed = []
        for segment in self.folder.entries("segments"):
            parts = {f"segments/{segment}/{n}": at for n, at in self.folder.entries(f"segments/{segment}").items()}
            old = [n for n, at in parts.items() if n not in used and at / 1000 <= now - grace]
            for name in [f"segments/{segment}"] if len(old) == len(parts) else old:
                self.folder.remove(name)
                removed.append(name)
        for name, at in self.folder.entries("staged").items():
            if at / 1000 <= now - grace:  # of a batch that failed
                self.folder.remove(f"staged/{name}")
                removed.append(f"staged/{name}")
        for name in names[:-1]:
            if name not in keep:
                self.folder.remove(f"versions/{name}")
        return removed

    # --- audits -----------------------------------------------------------------------------------

    def audit(self, segment: str | None = None) -> DataFrame:
        """``(check, violations)`` of the whole index, or what one segment adds to those before it.

        The live rows of all segments in their order add up to the whole index, so their violations do too, and
        a new batch is checked at the cost of the batch and of the lists of URLs and words.
        """
        head = self.current()
        names = ("websites", "keywords", "postings", "links")
        if segment is None:
            return audit_index(*(self._live(head, name) for name in names))
        ids = [s["id"] for s in head["segments"]]
        at = ids.index(segment)
        own, before = head["segments"][at : at + 1], head["segments"][:at]
        batch = {name: self._live(head, name, own) for name in names}
        stored = {name: self._live(head, name, before) for name in names}
        repeat = bool(batch["websites"].join(stored["websites"], "url", "left_semi").limit(1).count()) if before else False
        # totals of the batch's words that later batches have moved
        later = self._live(head, "keywords", head["segments"][at + 1 :]) if at + 1 < len(ids) else None
        return audit_delta(batch, stored, repeat, later)

    # --- ledger and reports -----------------------------------------------------------------------

    def seed(self, names: DataFrame) -> int:
        """Add archives to do: ``file_name`` rows that the ledger does not know yet. Returns how many."""
        known = self.files()
        fresh = seed_ledger(names)
        if known is not None:
            fresh = fresh.join(known.select("file_name"), "file_name", "left_anti")
        count = fresh.count()
        if count:
            self.append(empty_index(self.spark), fresh)
        return count

    def pending(self) -> DataFrame:
        return pending_files(self.files())

    def failures(self) -> DataFrame:
        """``file_name, times, reason`` of archives that could not be read to their end; the reason is the greatest of theirs."""
        return self._live(self.current(), "failed").groupBy("file_name").agg(F.count(F.lit(1)).alias("times"), F.max("reason").alias("reason"))

    def add_report(self, **counters: int) -> None:
        names = [name.split()[0] for name in REPORT.split(", ")]
        self.folder.create(f"reports/{counters['version']:010}.json", json.dumps({name: counters.get(name) for name in names}))

    def reports(self) -> DataFrame:
        """Counters of each version that a run of the ingest has added."""
        return self.spark.read.schema(REPORT).json(self.folder.path("reports"))


def at_once(run: Callable, things) -> list:
    """Independent jobs next to each other, so that small ones do not wait for one another; their results in order."""
    with ThreadPoolExecutor(max(1, len(things))) as pool:
        return [done.result() for done in [pool.submit(run, thing) for thing in things]]


def _blank() -> dict:
    return {"id": uuid.uuid4().hex, "paths": {}, "dead": {}, "rows": {}, "files": {}, "bytes": {}, "ranges": {}, "manifests": {}}


def _copy(segment: dict) -> dict:
    return {name: dict(value) if isinstance(value, dict) else value for name, value in segment.items()}


def empty_index(spark: SparkSession) -> Index:
    """An index of no pages."""
    names = ("websites", "keyword_parts", "postings", "links")
    return Index(**{name: spark.createDataFrame([], TABLES[name][0]) for name in names}, rows=0)


def _power(value: str) -> Column:
    """Power of two at or below a positive number."""
    return F.floor(F.log2(F.col(value).cast("double"))).cast("int")


def _bit(bits: Column, position: Column) -> Column:
    """Whether a bit of a bitmap is set."""
    byte = F.conv(F.hex(F.substring(bits, (F.floor(position / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.pmod(F.floor(byte / F.pow(F.lit(2), position % 8)), F.lit(2)) == 1


def observed(counters: Observation) -> dict:
    """What was observed; nothing where the planner left an empty input out."""
    try:
        return counters.get
    except AssertionError:
        return {}
