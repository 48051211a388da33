"""Incremental ingest: each archive once, restarts without double counting."""

from __future__ import annotations

import hashlib
import uuid
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from webloom.operators.hosts import with_listed
from webloom.operators.language import LanguageModel
from webloom.operators.ledger import mark_processed, seed_ledger
from webloom.plans.index import build_index
from webloom.plans.pages import parse_pages
from webloom.plans.store import IndexStore, observed
from webloom.sources.warc import UNREADABLE, record_fields, scan_archives


@dataclass(frozen=True)
class IngestReport:
    """Counters of one batch."""

    version: int
    records_read: int
    records_matching: int  # of listed hosts, with a body that decodes
    records_damaged: int
    pages_valid: int
    pages_added: int
    files_left: int


ROUNDS = 4  # tasks of a scan for each core

_FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"


def scan_tasks(archives: DataFrame) -> int:
    """Tasks that read a batch: one for each archive, or ``ROUNDS`` for each core if that is fewer. A task has a fixed
    cost and leaves a file, which would add up to more than the reading of many small archives."""
    return max(1, min(archives.count(), ROUNDS * archives.sparkSession.sparkContext.defaultParallelism))


def ingest_archives(
    store: IndexStore,
    archives: DataFrame,
    allowlist: DataFrame,
    dictionary: DataFrame | None,
    model: LanguageModel,
    note: str = "",
) -> IngestReport:
    """Index ``(file_id, path)`` archives and add them to the store.

    Records of listed hosts are stored first, with those that are damaged: reading an archive is
    one task's work, but what it held is then spread over all tasks for the parser, and counts
    are taken while they are stored. Parsed pages are stored as well, as four tables read them. Index
    and ledger are committed together, so a failure leaves the former version and its pending
    files as they were. An archive that cannot be opened or read to its end, or whose compression is damaged, is indexed as far as
    it can be read, reported with the reason and stays pending; the others are done. Then segments that are due are merged.
    """
    spark = store.spark
    read, kept_counts, parsed_counts = Observation(), Observation(), Observation()
    good, unread = F.col("_corrupt_record").isNull(), F.col("_corrupt_record").startswith(UNREADABLE)
    scanned = scan_archives(archives, tasks=scan_tasks(archives), report_unreadable=True).observe(
        read, F.count_if(good).alias("good"), F.count_if(~good & ~unread).alias("damaged")
    )
    listed = with_listed(record_fields(scanned, "_corrupt_record"), allowlist)
    staged = f"staged/{uuid.uuid4().hex}"
    kept = listed.filter((F.col("listed") & good) | ~good).drop("listed").observe(
        kept_counts, F.count_if(good & F.is_valid_utf8(F.col("body").cast("string"))).alias("matching"), F.count_if(~good).alias("bad")
    )
    kept.write.parquet(store.folder.path(f"{staged}/records"))
    records = spark.read.schema(kept.schema).parquet(store.folder.path(f"{staged}/records"))

    parsed = parse_pages(records.filter(good).drop("_corrupt_record"), model).select(
        "file_id", "record_no", "url", "title", "description", "tokens", "links"
    )
    has_fields = F.col("title").isNotNull() & F.col("description").isNotNull() & F.col("url").isNotNull()
    parsed = parsed.observe(parsed_counts, F.count(F.lit(1)).alias("valid"), F.count_if(has_fields).alias("added"))
    parsed.write.parquet(store.folder.path(f"{staged}/pages"))
    pages = spark.read.schema(parsed.schema).parquet(store.folder.path(f"{staged}/pages"))
    batch = build_index(pages, dictionary, staging=store.folder.path(staged))

    broken = records.filter(F.col("_corrupt_record").startswith("damaged compression") | unread)
    broken = broken.groupBy("file_id").agg(F.max("_corrupt_record").alias("reason"))
    names = archives.select("file_id", F.col("path").alias("file_name"))
    if observed(kept_counts).get("bad", 0):
        failed = names.join(broken, "file_id").select("file_name", "reason")
        whole = names.join(broken, "file_id", "left_anti")
    else:
        failed, whole = None, names
    ledger = mark_processed(seed_ledger(names.select("file_name")), whole.select("file_name"))
    version = store.append(batch, ledger, note, archives.select("file_id"), failed)
    report = IngestReport(
        version=version, records_read=observed(read).get("good", 0), records_matching=observed(kept_counts).get("matching", 0),
        records_damaged=observed(read).get("damaged", 0), pages_valid=observed(parsed_counts).get("valid", 0),
        pages_added=observed(parsed_counts).get("added", 0), files_left=store.pending().count(),
    )
    store.add_report(**asdict(report))
    store.folder.remove(staged)
    store.merge_due()
    return report


def ingest_pending(
    store: IndexStore,
    allowlist: DataFrame,
    dictionary: DataFrame | None,
    model: LanguageModel,
    most: int | None = None,
    file_id=lambda path: path,
    note: str = "",
) -> IngestReport | None:
    """Index the archives that the store's ledger has as pending, ``most`` of them at a time.

    ``store.seed(names)`` adds archives to do. None if nothing is pending. Archives that have failed come after those that
    have not, so a damaged one does not keep others waiting.
    """
    if store.current() is None:
        return None
    names = store.pending().join(store.failures(), "file_name", "left").orderBy(F.coalesce("times", F.lit(0)), "file_name")
    names = names.limit(most) if most else names
    archives = names.select(file_id(F.col("file_name")).alias("file_id"), F.col("file_name").alias("path"))
    # which files a batch has must not change while it runs: their names are few and short
    rows = [tuple(r) for r in archives.collect()]
    if not rows:
        return None
    archives = store.spark.createDataFrame(rows, "file_id string, path string")
    return ingest_archives(store, archives, allowlist, dictionary, model, note)


def ingest_stream(
    spark: SparkSession,
    archive_dir: str,
    store: IndexStore,
    checkpoint: str,
    allowlist: DataFrame,
    dictionary: DataFrame | None,
    model: LanguageModel,
    max_files: int | None = None,
    file_id=lambda path: path,
    max_bytes: int | None = None,
) -> StreamingQuery:
    """Structured Streaming over the archives of a folder; ends when none are left.

    A batch takes at most ``max_files`` archives, or as many as fit into ``max_bytes``.

    The stream carries paths only and the checkpoint remembers them. A batch that
    is run again after a failure finds its own note in the store and stops.
    """
    source = (
        spark.readStream.format("binaryFile")
        .schema(_FILE_SCHEMA)
        .option("pathGlobFilter", "*.gz")
        .option("recursiveFileLookup", "true")
    )
    if max_files:
        source = source.option("maxFilesPerTrigger", str(max_files))
    if max_bytes:
        source = source.option("maxBytesPerTrigger", str(max_bytes))
    paths = source.load(archive_dir).select(file_id(F.col("path")).alias("file_id"), "path")

    stream_name = hashlib.md5(checkpoint.encode()).hexdigest()

    def run(batch: DataFrame, batch_id: int) -> None:
        note = f"{stream_name}-{batch_id}"
        if store.has(note):
            return
        ingest_archives(store, batch, allowlist, dictionary, model, note)

    return (
        paths.writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
