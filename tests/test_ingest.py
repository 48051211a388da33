"""Archives to a stored index: parsing plan, language gate, stream against batch."""

import gzip
import math
import os

import pytest
from pyspark.sql import functions as F

from test_index import as_dict, rows
from test_sources import record
from webloom import IndexStore, build_index, detect_language, filter_hosts, ingest_stream, parse_pages, train_language_model
from webloom.operators.language import language_weights, trigram_counts
from webloom.plans.counters import scan_counters
from webloom.sources.warc import archive_paths, read_warc, record_fields
from webloom.streaming import ingest
from webloom.streaming.ingest import ingest_archives, ingest_pending

ENGLISH = "the quick brown fox jumps over the lazy dog while the children were watching them from the window of this house"
GERMAN = "der schnelle braune fuchs springt über den faulen hund während die kinder ihn aus dem fenster des hauses beobachten"


@pytest.fixture(scope="module")
def model(spark):
    return train_language_model(spark.createDataFrame([(ENGLISH, "en"), (GERMAN, "de")], "text string, lang string"))


def page(title, text, link="/x"):
    head = "HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n"
    return (head + f"<!DOCTYPE html><html><title>{title}</title><p>{text}<a href='{link}'>the house</a>").encode()


def write_archive(folder, name, members):
    path = folder / name
    path.write_bytes(b"".join(gzip.compress(m) for m in members))
    number = int(name[2:7])
    os.utime(path, (1_700_000_000 + number,) * 2)  # the stream takes files as they arrived


@pytest.fixture
def crawl(spark, tmp_path):
    folder = tmp_path / "crawl"
    folder.mkdir()
    write_archive(folder, "c-00000.warc.gz", [
        record("http://a.org/1", page("One", "the dog jumps over the window")),
        record("http://a.org/2", page("Zwei", "der hund springt über den faulen fuchs")),
        record("http://other.org/", page("Other", "the children were watching")),
        record("http://a.org/3", page("Broken", "the house").replace(b"house", b"\xff")),
        record("http://a.org/4", b"HTTP/1.1 200 OK\r\nContent-Type: image/png\r\n\r\n<html>"),
        record("http://a.org/5", b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n<html></html>"),
        record("", b"warcinfo"),
    ])
    write_archive(folder, "c-00001.warc.gz", [
        record("http://b.org/1", page("Two", "the brown fox was watching them from the house")),
        record("http://a.org/1", page("Once more", "the quick children of this house", "/y")),
    ])
    allow = spark.createDataFrame([("a.org",), ("b.org",)], "host string")
    return folder, allow


@pytest.mark.parametrize("bound", [10, 0])
def test_scan_counters_with_a_short_or_a_long_site_list(spark, crawl, model, bound):
    folder, allow = crawl
    records = record_fields(read_warc(spark, str(folder)))
    kept = filter_hosts(records, allow, bound)
    assert sorted(r.target_uri for r in kept.select("target_uri").collect()) == sorted(
        [f"http://a.org/{n}" for n in (1, 1, 2, 3, 4, 5)] + ["http://b.org/1"]
    )
    found = scan_counters(records, allow, model, bound)
    assert sorted(tuple(r)[1:] for r in found.collect()) == [(2, 2, 2), (7, 4, 1)]


def test_parse_pages(spark, crawl, model):
    folder, allow = crawl
    records = filter_hosts(record_fields(read_warc(spark, str(folder))), allow, 10)
    found = {(r.url, r.title): r for r in parse_pages(records, model).collect()}
    assert set(found) == {
        ("http://a.org/1", "One"), ("http://b.org/1", "Two"), ("http://a.org/1", "Once more"),
    }
    one = found["http://a.org/1", "One"]
    assert one.description == "One" and one.links == ["http://a.org/x"] and one.lang == "en"
    assert one.tokens == "onethe dog jumps over the windowthe house".split()
    assert {r.title for r in parse_pages(records, model, language=None).collect()} >= {"Zwei"}


def test_parser_runs_once_and_only_on_kept_records(spark, crawl, model):
    folder, allow = crawl
    records = filter_hosts(record_fields(read_warc(spark, str(folder))), allow, 10)
    plan = parse_pages(records, model)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
    assert plan.index("ArrowEvalPython") < plan.index("BroadcastHashJoin")  # printed from the top down


def test_stream_equals_batch_and_does_not_repeat(spark, crawl, model, tmp_path):
    folder, allow = crawl
    lemmas = spark.createDataFrame([("was", "be"), ("were", "be")], "word string, lemma string")
    streamed, batch = IndexStore(spark, str(tmp_path / "s")), IndexStore(spark, str(tmp_path / "b"))
    checkpoint = str(tmp_path / "checkpoint")

    def run():
        ingest_stream(spark, str(folder), streamed, checkpoint, allow, lemmas, model, max_files=1).awaitTermination()

    run()
    report = ingest_archives(batch, archive_paths(spark, str(folder)), allow, lemmas, model)
    assert (report.records_read, report.pages_valid, report.pages_added) == (9, 3, 3)
    assert as_dict(streamed.read()) == as_dict(batch.read())
    assert [r.title for r in streamed.read().websites.orderBy("url").collect()] == ["Once more", "Two"]
    version = streamed.current()
    run()
    assert streamed.current() == version  # nothing left to do

    write_archive(folder, "c-00002.warc.gz", [record("http://b.org/2", page("Three", "the lazy dog"))])
    run()
    assert streamed.current()["version"] == version["version"] + 1
    assert streamed.read().websites.count() == 3
    assert [r.processed for r in streamed.files().collect()] == [True] * 3
    everything = build_index(
        parse_pages(filter_hosts(record_fields(read_warc(spark, str(folder))), allow, 10), model), lemmas
    )
    assert as_dict(streamed.read()) == as_dict(everything)


def test_stream_by_bytes_goes_on_where_it_was_stopped(spark, crawl, model, tmp_path, monkeypatch):
    folder, allow = crawl
    write_archive(folder, "c-00002.warc.gz", [record("http://b.org/2", page("Three", "the lazy dog"))])
    store, batch = IndexStore(spark, str(tmp_path / "s")), IndexStore(spark, str(tmp_path / "b"))
    whole, batches = ingest.ingest_archives, []

    def stopped(store, archives, *others):
        batches.append(archives.count())
        if len(batches) == 2:
            raise RuntimeError("driver lost")
        return whole(store, archives, *others)

    def run():
        stream = ingest.ingest_stream(spark, str(folder), store, str(tmp_path / "c"), allow, None, model, max_bytes=10)
        stream.awaitTermination()

    monkeypatch.setattr(ingest, "ingest_archives", stopped)
    with pytest.raises(Exception, match="driver lost"):
        run()
    assert store.files().count() == 1
    run()
    assert batches == [1, 1, 1, 1]  # the second batch ran again
    whole(batch, archive_paths(spark, str(folder)), allow, None, model)
    assert as_dict(store.read()) == as_dict(batch.read()) and store.pending().count() == 0


def test_archive_run_twice_counts_once(spark, crawl, model, tmp_path):
    folder, allow = crawl
    store = IndexStore(spark, str(tmp_path / "s"))
    for note in ("first", "again"):
        ingest_archives(store, archive_paths(spark, str(folder)), allow, None, model, note)
    once = IndexStore(spark, str(tmp_path / "o"))
    ingest_archives(once, archive_paths(spark, str(folder)), allow, None, model)
    assert as_dict(store.read()) == as_dict(once.read())


@pytest.mark.parametrize("archives", [1, 8])
def test_batch_without_listed_records_is_committed(spark, model, tmp_path, archives):
    folder = tmp_path / "crawl"
    folder.mkdir()
    for n in range(archives):
        write_archive(folder, f"c-{n:05}.warc.gz", [record("http://other.org/", page("Other", "the children"))])
    store = IndexStore(spark, str(tmp_path / "s"))
    allow = spark.createDataFrame([("a.org",)], "host string")
    ingest_stream(spark, str(folder), store, str(tmp_path / "c"), allow, None, model).awaitTermination()
    assert store.read().websites.count() == 0
    assert [r.processed for r in store.files().collect()] == [True] * archives
    assert store.reports().collect()[0].records_read == archives


def test_archive_with_damage_only_stays_pending(spark, model, tmp_path):
    folder = tmp_path / "crawl"
    folder.mkdir()
    (folder / "c-00000.warc.gz").write_bytes(gzip.compress(b"x" * 5000)[:-9] + b"rest")
    store = IndexStore(spark, str(tmp_path / "s"))
    allow = spark.createDataFrame([("a.org",)], "host string")
    ingest_stream(spark, str(folder), store, str(tmp_path / "c"), allow, None, model).awaitTermination()
    assert store.pending().count() == 1 and store.reports().collect()[0].files_left == 1


def test_work_list_is_done_in_steps(spark, crawl, model, tmp_path):
    folder, allow = crawl
    store = IndexStore(spark, str(tmp_path / "s"))
    names = archive_paths(spark, str(folder)).select(F.col("path").alias("file_name"))
    assert store.seed(names) == 2 and store.seed(names) == 0
    reports = [ingest_pending(store, allow, None, model, most=1, note=f"run-{n}") for n in range(3)]
    assert [(r.records_read, r.records_matching, r.pages_valid, r.files_left) for r in reports[:2]] == [(7, 4, 1, 1), (2, 2, 2, 0)]
    assert reports[2] is None
    once = IndexStore(spark, str(tmp_path / "o"))
    ingest_archives(once, archive_paths(spark, str(folder)), allow, None, model)
    assert as_dict(store.read()) == as_dict(once.read())


def test_emptied_archive_loses_its_counts(spark, crawl, model, tmp_path):
    folder, allow = crawl
    store = IndexStore(spark, str(tmp_path / "s"))
    for note in ("first", "again"):
        ingest_archives(store, archive_paths(spark, str(folder)), allow, None, model, note)
        write_archive(folder, "c-00001.warc.gz", [record("http://other.org/", page("Other", "the children"))])
    words = {r.word for r in store.read().keywords.collect()}
    assert "fox" not in words and "dog" in words
    store.compact()
    assert {r.word for r in store.read().keywords.collect()} == words


def test_archive_that_cannot_be_read_fails_alone(spark, crawl, model, tmp_path):
    folder, allow = crawl
    store, whole = IndexStore(spark, str(tmp_path / "s")), IndexStore(spark, str(tmp_path / "w"))
    names = archive_paths(spark, str(folder)).select(F.col("path").alias("file_name"))
    gone = "file:" + str(folder / "a-00009.warc.gz")  # first by name
    store.seed(names.unionByName(spark.createDataFrame([(gone,)], "file_name string")))
    report = ingest_pending(store, allow, None, model, note="run-1")
    assert (report.records_read, report.records_damaged, report.files_left) == (9, 0, 1)
    assert [r.file_name for r in store.pending().collect()] == [gone]
    (failed,) = store.failures().collect()
    assert failed.file_name == gone and failed.times == 1 and failed.reason.startswith("unreadable archive: ")
    ingest_archives(whole, archive_paths(spark, str(folder)), allow, None, model)
    assert as_dict(store.read()) == as_dict(whole.read())
    # it comes after archives that have not failed yet, and is done once it can be read
    write_archive(folder, "c-00002.warc.gz", [record("http://b.org/2", page("Three", "the lazy dog"))])
    store.seed(archive_paths(spark, str(folder)).select(F.col("path").alias("file_name")))
    assert ingest_pending(store, allow, None, model, most=1, note="run-2").pages_added == 1
    write_archive(folder, "a-00009.warc.gz", [record("http://b.org/3", page("Four", "the lazy children"))])
    assert ingest_pending(store, allow, None, model, most=1, note="run-3").files_left == 0
    assert store.read().websites.count() == 4
    assert store.folder.entries("staged") == {}


def test_failing_batch_leaves_the_former_version(spark, crawl, model, tmp_path, monkeypatch):
    folder, allow = crawl
    store = IndexStore(spark, str(tmp_path / "s"))
    store.seed(archive_paths(spark, str(folder)).select(F.col("path").alias("file_name")))
    before = store.current()
    broken = allow.withColumn("host", F.raise_error(F.lit("disk gone")).cast("string"))
    with pytest.raises(Exception, match="disk gone"):
        ingest_archives(store, archive_paths(spark, str(folder)), broken, None, model)
    assert store.current() == before and store.pending().count() == 2


def test_language_on_unseen_pages(spark):
    """Trained on the documents table, judged by the language in the pages' URLs."""
    folder = "/root/testdata/sf0.001"
    trained = train_language_model(spark.read.parquet(f"{folder}/documents.parquet"))
    pages = spark.read.parquet(f"{folder}/pages.parquet").withColumn("expected", F.regexp_extract("url", r"/(en|fr|de|es)/", 1))
    text = F.regexp_replace("html", "<[^>]*>", " ")
    found = rows(pages.select("expected", detect_language(text, trained).alias("lang")))
    assert sum(expected == lang for expected, lang in found) >= 0.95 * len(found)
    empty = spark.createDataFrame([("",), (None,), ("x",)], "t string")
    assert [r[0] is None for r in empty.select(detect_language(F.col("t"), trained)).collect()] == [True, True, False]


def test_model_is_trained_in_one_pass_over_the_text(spark):
    texts = spark.createDataFrame([(ENGLISH, "en"), (GERMAN, "de"), (ENGLISH, None)], "text string, lang string")
    counts = trigram_counts(texts)
    weights = language_weights(counts)
    assert weights._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    found = {(r.lang, r.bucket): r.weight for r in weights.collect()}
    n = {(r.lang, r.bucket): r.n for r in counts.collect()}
    total = {lang: sum(v for (k, _), v in n.items() if k == lang) for lang in ("en", "de")}
    expected = {(k, b): v for (k, b), v in n.items()} | {(k, -1): 0 for k in total}
    assert found == {(k, b): round(1000 * math.log((v + 1) / (total[k] + 4096))) for (k, b), v in expected.items()}


def test_small_archives_share_tasks(spark, crawl, model, tmp_path):
    folder, allow = crawl
    for n in range(2, 30):
        write_archive(folder, f"c-{n:05}.warc.gz", [record(f"http://a.org/x{n}", page("More", "the dog of the children"))])
    archives = archive_paths(spark, str(folder))
    most = ingest.ROUNDS * spark.sparkContext.defaultParallelism
    assert archives.count() == 30 > most == ingest.scan_tasks(archives)
    assert ingest.scan_tasks(archives.limit(1)) == ingest.scan_tasks(archives.limit(0)) == 1
    scanned = ingest.scan_archives(archives, tasks=most)
    found = scanned.groupBy(F.spark_partition_id()).agg(F.count_distinct("file_id").alias("n")).collect()
    assert len(found) == most and {r["n"] for r in found} <= {30 // most, 30 // most + 1}
    store = IndexStore(spark, str(tmp_path / "packed"))
    report = ingest_archives(store, archives, allow, None, model)
    assert (report.records_read, report.files_left) == (9 + 28, 0)
    assert {"http://a.org/x2", "http://a.org/x29"} <= {r.url for r in store.read().websites.collect()}
