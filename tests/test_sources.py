"""Line files, archives and the lemma dictionary."""

import gzip
import io
import os

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from webloom import lemma_dictionary, lemmatise, read_lines, register_warc_source, scan_archives, site_allowlist
from webloom.operators.hosts import filter_hosts
from webloom.operators.lemmas import counted_words, frequent_from, lemmatise_rows
from webloom.sources.lines import file_number, first_lines
from webloom.sources.warc import archive_paths, iter_records, read_warc, record_fields, split_path


def ordered(lines):
    return [r.line for r in lines.orderBy("line_pos").collect()]


def test_lines_keep_order_blanks_and_lone_cr(spark, tmp_path):
    path = tmp_path / "list.txt"
    path.write_bytes(b"b\r\na\n\nx\ry\nb\r\n last")
    assert ordered(read_lines(spark, str(path))) == ["b", "a", "", "x\ry", "b", " last"]
    assert ordered(first_lines(read_lines(spark, str(path)), 2)) == ["b", "a"]


def test_line_order_survives_splits(spark, tmp_path):
    path = tmp_path / "many.txt"
    path.write_text("".join(f"{n}\n" for n in range(200_000, 0, -1)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        lines = read_lines(spark, str(path))
        assert lines.rdd.getNumPartitions() > 4
        assert ordered(first_lines(lines, 20_000)) == [str(n) for n in range(200_000, 180_000, -1)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_allowlist_is_cut_before_it_is_deduplicated(spark, tmp_path):
    path = tmp_path / "sites.txt"
    path.write_text("a.org\na.org\nB.org\nc.org\n")
    hosts = site_allowlist(read_lines(spark, str(path)), 3)
    assert {r.host for r in hosts.collect()} == {"a.org", "B.org"}
    urls = ["http://A.org/", "http://www.a.org/", "http://b.org/", "http://c.org/", "nohost"]
    records = spark.createDataFrame([(u,) for u in urls], "target_uri string")
    assert [r.target_uri for r in filter_hosts(records, hosts, 3).collect()] == ["http://A.org/"]


def test_file_number(spark):
    row = spark.createDataFrame([("a-b/CC-MAIN-2024-00012.warc.gz",), ("plain.gz",)], "p string")
    assert [r[0] for r in row.select(file_number(F.col("p"))).collect()] == ["00012", "plain"]


def test_lemma_dictionary(spark, tmp_path):
    path = tmp_path / "lemmas.txt"
    path.write_text(
        "be/12 -> is,are , was\nrun/5 -> runs,ran,\nnoslash -> seen\na->b->c\nx/1-2 -> skipped\n"
        "late/1 -> is\nMixed/2 -> Upper,lower\nno arrow\nhave/3 ->\u00a0has,\thad\n"
    )
    found = {r.word: r.lemma for r in lemma_dictionary(read_lines(spark, str(path))).collect()}
    assert found == {
        "is": "late", "are": "be", "was": "be", "runs": "run", "ran": "run", "": "run", "seen": "noslash",
        "c": "a->b", "Upper": "Mixed", "lower": "Mixed", "has": "have", "had": "have",
    }


@pytest.mark.parametrize("bound", [1_000_000, 1])
def test_lemmatise_keeps_order_and_repeats_on_either_path(spark, bound):
    dictionary = spark.createDataFrame([("is", "be"), ("was", "be"), ("UP", "x")], "word string, lemma string")
    pages = spark.createDataFrame([(1, ["it", "is", "was", "is"]), (2, ["up"]), (3, [])], "id int, words array<string>")
    rows = lemmatise(pages, "words", dictionary, ["id"], bound).collect()
    assert sorted((r.id, r.pos, r.word) for r in rows) == [
        (1, 0, "it"), (1, 1, "be"), (1, 2, "be"), (1, 3, "be"), (2, 0, "up"),
    ]


def test_frequent_words_do_not_shuffle_with_a_large_dictionary(spark):
    """Rare words, frequent ones with and without a lemma, and none: all rows once, and frequent ones not moved."""
    dictionary = spark.createDataFrame([(f"w{n}", f"l{n}") for n in range(40)] + [("was", "be")], "word string, lemma string")
    words = ["was", "the", None] * 100 + [f"w{n}" for n in range(60)] + ["w1", "w59"]
    rows = spark.createDataFrame(list(enumerate(words)), "n int, word string")
    joined = lemmatise_rows(rows, dictionary, 3)
    lemmas = {f"w{n}": f"l{n}" for n in range(40)} | {"was": "be"}
    assert sorted(map(str, joined.select("n", "word").collect())) == sorted(
        str(Row(n=n, word=lemmas.get(w, w))) for n, w in enumerate(words)
    )
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "LeftOuter, BuildRight" in plan and "LeftAnti, BuildRight" in plan
    counts, present = counted_words(rows, dictionary)
    assert counts.count() == 62 and present.count() == 41
    assert [frequent_from(counts, most) for most in (1, 3, 4, 62)] == [None, 64, 2, 1]


def test_only_the_needed_part_of_a_large_dictionary_is_broadcast(spark):
    dictionary = spark.range(1000).selectExpr("'w' || id AS word", "'l' || id AS lemma")
    rows = spark.createDataFrame([(n, f"w{n % 3 * 600}") for n in range(90)] + [(90, None)], "n int, word string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = lemmatise_rows(rows, dictionary, 10)
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
    assert {(r.n, r.word) for r in joined.collect()} == {(n, ["l0", "l600", "w1200"][n % 3]) for n in range(90)} | {(90, None)}


def record(uri, body, **headers):
    lines = [b"WARC/1.0", b"WARC-Type: response"]
    lines += [f"WARC-Target-URI: {uri}".encode()] if uri else []
    lines += [f"{k.replace('_', '-')}: {v}".encode() for k, v in ({"Content_Length": len(body)} | headers).items()]
    return b"\r\n".join(lines) + b"\r\n\r\n" + body + b"\r\n\r\n"


GOOD = [record("http://a.org/", b"one\r\n\r\nWARC/1.0\r\ninside"), record(None, b"two"), record("http://c.org/", b"")]


def archive(path, parts):
    path.write_bytes(b"".join(gzip.compress(part) for part in parts))  # one member per record
    return str(path)


def test_archive_records(spark, tmp_path):
    archive(tmp_path / "x-00000.warc.gz", GOOD)
    (tmp_path / "x-00001.warc.gz").write_bytes(b"")
    rows = record_fields(read_warc(spark, str(tmp_path))).orderBy("record_no").collect()
    assert [(r.record_no, r.target_uri, bytes(r.body)) for r in rows] == [
        (0, "http://a.org/", b"one\r\n\r\nWARC/1.0\r\ninside"), (1, "", b"two"), (2, "http://c.org/", b""),
    ]
    assert {r.warc_type for r in rows} == {"response"} and rows[0].content_length == 23
    register_warc_source(spark)
    assert spark.read.format("warc").load(str(tmp_path)).count() == 3


@pytest.mark.parametrize("damage", [
    record("http://d.org/", b"body", Content_Length="many"),
    record("http://d.org/", b"body", Content_Length="-4"),
    b"WARC/1.0\r\nno colon here\r\nContent-Length: 4\r\n\r\nbody\r\n\r\n",
    b"not a record at all\r\nsecond line\r\n\r\n",
])
def test_damaged_record_is_reported_once_and_skipped(spark, tmp_path, damage):
    path = archive(tmp_path / "x-0.warc.gz", [GOOD[0], damage, GOOD[1], GOOD[2]])
    rows = scan_archives(archive_paths(spark, path)).collect()
    assert [r._corrupt_record is None for r in sorted(rows, key=lambda r: r.record_no)] == [True, False, True, True]
    assert read_warc(spark, path).count() == 3


def scanned(spark, path):
    rows = scan_archives(archive_paths(spark, str(path))).orderBy("record_no").collect()
    return [r._corrupt_record or r.headers.get("warc-target-uri", "") for r in rows]


def test_damage_costs_only_the_damaged_members(spark, tmp_path):
    names = [f"http://m.org/{n}" for n in range(24)]
    members = [gzip.compress(record(n, os.urandom(3000))) for n in names]
    for bad in (0, 7, 8, 23):
        member = bytearray(members[bad])
        member[len(member) // 2 : len(member) // 2 + 40] = b"\xff" * 40
        members[bad] = bytes(member)
    (tmp_path / "x-0.warc.gz").write_bytes(b"".join(members))
    found = scanned(spark, tmp_path)
    assert [f for f in found if f.startswith("http")] == [n for i, n in enumerate(names) if i not in (0, 7, 8, 23)]
    assert sum(f.startswith("damaged compression") for f in found) == 4


def test_wrong_checksum_and_garbage_between_members(spark, tmp_path):
    one, two, three = (gzip.compress(r) for r in (record(f"http://{n}.org/", b"x" * 50) for n in "abc"))
    wrong = two[:-8] + b"\0\0\0\0" + two[-4:]
    (tmp_path / "x-0.warc.gz").write_bytes(one + wrong + b"\0\0" + three)
    found = scanned(spark, tmp_path)
    assert found[0] == "http://a.org/" and "incorrect data check" in found[1] and found[2:] == ["http://c.org/"]
    (tmp_path / "x-0.warc.gz").write_bytes(one + b"garbage" + three)
    assert [f for f in scanned(spark, tmp_path) if f.startswith("http")] == ["http://a.org/", "http://c.org/"]


def test_cut_off_archive(spark, tmp_path):
    whole = gzip.compress(GOOD[0]) + gzip.compress(GOOD[2])
    (tmp_path / "x-0.warc.gz").write_bytes(whole[:-20])
    assert scanned(spark, tmp_path) == ["http://a.org/", "damaged compression: cut off"]
    short = list(iter_records(io.BytesIO(record("u", b"abc", Content_Length=50))))
    assert short[0][2] == "body cut off"


def test_bodies_of_malformed_records_are_passed_over_and_lines_have_no_limit(spark, tmp_path):
    inside = record("http://phantom.org/", b"no record")
    bad = b"WARC/1.0\r\nno colon here\r\nContent-Length: %d\r\n\r\n" % len(inside) + inside + b"\r\n\r\n"
    long = "http://l.org/" + "x" * 70_000
    archive(tmp_path / "x-0.warc.gz", [GOOD[0], bad, record(long, b"body")])
    assert scanned(spark, tmp_path) == ["http://a.org/", "malformed header: no colon here", long]


def test_paths_of_file_systems():
    assert split_path("s3a://bucket/a.gz") == ("s3", "s3://bucket/a.gz")
    assert split_path("hdfs://name:8020/a.gz") == ("hdfs", "hdfs://name:8020/a.gz")
    assert split_path("file:/tmp/a#b?c.gz") == split_path("file:///tmp/a#b?c.gz") == ("", "/tmp/a#b?c.gz")
    with pytest.raises(ValueError):
        split_path("ftp://x/a.gz")


def test_each_archive_is_a_task(spark, tmp_path):
    for n in range(64):
        archive(tmp_path / f"x-{n:02}.warc.gz", [GOOD[0]])
    tasks = read_warc(spark, str(tmp_path)).groupBy(F.spark_partition_id()).count().collect()
    assert len(tasks) == 64 and {r["count"] for r in tasks} == {1}


def test_missing_archive_fails_the_job(spark):
    missing = spark.createDataFrame([("x", "/nowhere/x.warc.gz")], "file_id string, path string")
    with pytest.raises(Exception):
        scan_archives(missing).count()
