"""Segments, versions, lookups, merges and concurrent writers of the stored index."""

import time
from concurrent.futures import ThreadPoolExecutor
from threading import Barrier

import pytest
from pyspark.sql import functions as F

from test_index import CRAWL, as_dict, brute_force, lemmas, pages, rows
from webloom import IndexStore, build_index, merge_index
from webloom.plans import store as store_plan
from webloom.plans.store import Conflict
from webloom.sources.folder import SharedFolder

BATCHES = [
    [r for r in CRAWL if r[0] == "a"],
    [("b", 0, "u2", "t3", "t3", ["fresh"], ["l9"]), ("b", 1, "u1", "T", "T", [], None)],
    [("c", 0, "u1", "back", "back", ["both", "is"], ["l1"]), ("c", 1, "u6", "t", "t", ["both"], None)],
]


def done(spark, *names):
    return spark.createDataFrame([(n, True) for n in names], "file_name string, processed boolean")


def lookups(store, batches):
    """Every lookup against what it says of the tables read whole."""
    index = store.read()
    expected = brute_force(batches)
    assert as_dict(index) == expected
    words = {w: n for w, n in expected["keywords"]}
    for chosen in (["both"], ["be", "fresh", "absent"], []):
        assert rows(store.postings_of(chosen)) == sorted(p for p in expected["postings"] if p[0] in chosen)
    assert rows(store.postings_of(["both"], 2)) == sorted(p for p in expected["postings"] if p[0] == "both" and p[2] >= 2)
    for low, high in ((1, 1), (2, 3), (1, 99), (50, 60)):
        assert rows(store.keywords_by_df(low, high)) == sorted((w, n) for w, n in words.items() if low <= n <= high)
    for count in (1, 2, 99):
        best = sorted(words.items(), key=lambda x: (-x[1], x[0]))[:count]
        assert [tuple(r) for r in store.top_keywords(count).collect()] == best
    links = expected["links"]
    assert rows(store.links_from(["u1"])) == sorted(x for x in links if x[0] == "u1")
    assert rows(store.links_to(["l1", "l9"])) == sorted(x for x in links if x[1] in ("l1", "l9"))
    assert {tuple(r) for r in store.inlink_counts().collect()} == {(t, sum(x[1] == t for x in links)) for _, t in links}
    assert {tuple(r) for r in store.outlink_counts().collect()} == {(s, sum(x[0] == s for x in links)) for s, _ in links}
    frequencies = store.current()["frequencies"]
    assert sum(frequencies.values()) == len(words) and all(n > 0 for n in frequencies.values())


def test_batches_read_as_merged_and_looked_up(spark, tmp_path):
    store = IndexStore(spark, str(tmp_path / "index"))
    assert store.current() is None and store.read() is None and store.files() is None
    for number, batch in enumerate(BATCHES):
        store.append(build_index(pages(spark, batch), lemmas(spark)), done(spark, f"f{number}"))
    lookups(store, BATCHES)
    store.append(build_index(pages(spark, BATCHES[2]), lemmas(spark)), done(spark, "f2"))  # the same batch again
    assert as_dict(store.read()) == brute_force(BATCHES)
    assert len(store.current()["segments"]) == 4
    store.compact()
    lookups(store, BATCHES)
    assert len(store.current()["segments"]) == 1 and not store.current()["deletes"]
    assert rows(store.files()) == [("f0", True), ("f1", True), ("f2", True)]
    last = [("d", *r[1:]) for r in CRAWL if r[0] == "b"]
    merged = merge_index(store.read(), build_index(pages(spark, last), lemmas(spark)))
    assert store.publish(merged, done(spark, "f"), "two") == store.current()["version"]
    lookups(store, [*BATCHES, last])


def test_segments_without_replaced_rows_are_read_without_a_join(spark, tmp_path):
    store = IndexStore(spark, str(tmp_path / "index"))
    store.append(build_index(pages(spark, BATCHES[0]), None), done(spark, "f0"))
    other = [("z", n, f"v{n}", "t", "t", ["both", "far"], ["l1"]) for n in range(5)]
    store.append(build_index(pages(spark, other), None), done(spark, "f1"))

    def plan(frame):
        return frame._jdf.queryExecution().executedPlan().toString()

    for frame in (store.read().postings, store.read().links, store.postings_of(["both"]), store.outlink_counts()):
        assert "Join" not in plan(frame) and "Exchange" not in plan(frame)
    store.append(build_index(pages(spark, [("y", 0, "v1", "t", "t", ["new"], None)]), None), done(spark, "f2"))
    assert "BroadcastHashJoin" in plan(store.read().postings) and "SortMergeJoin" not in plan(store.read().postings)
    assert plan(store.links_from(["u1"])).count("Join") == 0  # its files are of a segment without replaced rows


def test_lookups_open_only_files_that_can_hold_the_key(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(store_plan, "ROWS_PER_FILE", 200)
    batch = [("a", n, f"u{n:04}", "t", "t", [f"w{n:04}", f"w{n + 1:04}", "same"], [f"l{n % 7}"]) for n in range(600)]
    store = IndexStore(spark, str(tmp_path / "index"))
    store.append(build_index(pages(spark, batch), None), done(spark, "f0"))
    files = store.current()["segments"][0]["files"]
    assert files["postings"] >= 8 and files["keywords"] >= 3 and files["links_by_source"] >= 3
    assert 1 <= len(store.files_with("postings", ["w0300"])) <= 2
    assert len(store.files_with("postings", ["same"])) >= 2  # a frequent word is spread
    assert len(store.files_with("postings", ["aaa"])) == 0 and store.postings_of(["aaa"]).count() == 0
    assert {tuple(r) for r in store.postings_of(["w0300"]).collect()} == {("w0300", "u0300", 1), ("w0300", "u0299", 1)}
    assert store.postings_of(["same"]).count() == 600
    assert len(store.postings_of(["w0300"]).inputFiles()) <= 2
    assert len(store.top_keywords(1).inputFiles()) <= 1
    assert [tuple(r) for r in store.top_keywords(2).collect()] == [("same", 600), ("w0001", 2)]


def one_page(spark, n):
    return build_index(pages(spark, [(f"a{n}", 0, f"u{n}", "t", "t", [f"w{n % 3}"], ["l"])]), None)


def test_many_batches_are_merged_by_size_and_cleaned(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(store_plan, "ROWS_PER_FILE", 128)  # a segment of one page is of class 0, of four of class 1
    store, written = IndexStore(spark, str(tmp_path / "index")), 0
    count = 10
    for n in range(count):
        store.append(one_page(spark, n), done(spark, f"f{n}"))
        store.merge_due()
        written = max(written, len(store.current()["segments"]))
    assert written <= 2 * store_plan.FAN - 1  # three of each of two classes, and one that is due
    assert len(store.current()["segments"]) <= 5
    assert store.read().postings.count() == count and rows(store.read().keywords) == [("w0", 4), ("w1", 3), ("w2", 3)]
    assert store.clean(grace=3600) == []  # all of it is young
    removed = store.clean(grace=0)
    assert removed and set(store.folder.entries("segments")) == {s["id"] for s in store.current()["segments"]}
    assert len(store.folder.entries("versions")) == 1
    assert store.read().postings.count() == count and store.inlink_counts().first()["inlinks"] == count


def test_reader_keeps_its_version_during_a_merge(spark, tmp_path):
    store = IndexStore(spark, str(tmp_path / "index"))
    for n in range(3):
        store.append(one_page(spark, n), done(spark, f"f{n}"))
    with store.reading() as held:
        before = store.read(held)
        store.compact()
        store.append(one_page(spark, 9), done(spark, "f9"))
        store.clean(grace=0)
        assert before.postings.count() == 3
    store.clean(grace=0)
    assert store.read().postings.count() == 4
    assert len(store.folder.entries("segments")) == 2 and store.folder.entries("leases") == {}


def test_two_writers_at_once_lose_nothing(spark, tmp_path, monkeypatch):
    """Both have written their tables for the same version before either commits."""
    root = str(tmp_path / "index")
    IndexStore(spark, root).append(build_index(pages(spark, BATCHES[0]), lemmas(spark)), done(spark, "f0"))
    barrier, tries = Barrier(2, timeout=120), []
    create = SharedFolder.create

    def together(self, name, text):
        if name.startswith("versions/"):
            tries.append(name)
            if len(tries) <= 2:
                barrier.wait()
        return create(self, name, text)

    monkeypatch.setattr(SharedFolder, "create", together)

    def write(number):
        store = IndexStore(spark, root)
        return store.append(build_index(pages(spark, BATCHES[number]), lemmas(spark)), done(spark, f"f{number}"), f"w{number}-0")

    with ThreadPoolExecutor(2) as pool:
        versions = sorted(pool.map(write, (1, 2)))
    assert versions == [2, 3] and len(tries) == 3  # one had to try again
    store = IndexStore(spark, root)
    found = as_dict(store.read())
    orders = [brute_force(order) for order in (BATCHES, [BATCHES[0], BATCHES[2], BATCHES[1]])]
    assert found in orders
    assert store.has("w1-0") and store.has("w2-0")
    lookups(store, BATCHES if found == orders[0] else [BATCHES[0], BATCHES[2], BATCHES[1]])


def test_merge_gives_way_to_a_batch_that_replaces_its_rows(spark, tmp_path):
    root = str(tmp_path / "index")
    store = IndexStore(spark, root)
    for n in range(2):
        store.append(one_page(spark, n), done(spark, f"f{n}"))
    write = store._write

    def meanwhile(segment, tables, *others):
        store._write = write
        IndexStore(spark, root).append(build_index(pages(spark, [("a7", 0, "u1", "t", "t", ["late"], None)]), None), done(spark, "f7"))
        return write(segment, tables, *others)

    store._write = meanwhile
    with pytest.raises(Conflict):
        store._merge([s["id"] for s in store.current()["segments"]])
    store.compact()
    assert rows(store.read().postings) == [("late", "u1", 1), ("w0", "u0", 1)]


def test_failed_batch_leaves_the_former_version(spark, tmp_path):
    store = IndexStore(spark, str(tmp_path / "index"))
    index = build_index(pages(spark), lemmas(spark))
    store.publish(index, done(spark, "f"))
    broken = build_index(pages(spark), lemmas(spark))
    broken.links = broken.links.withColumn("target_website", F.raise_error(F.lit("disk gone")).cast("string"))
    with pytest.raises(Exception, match="disk gone"):
        store.append(broken, done(spark, "f"))
    assert store.current()["version"] == 1
    assert store.publish(index, done(spark, "f")) == 2
    store.clean(grace=0)
    assert len(store.folder.entries("segments")) == 1


@pytest.mark.parametrize("shuffled", [False, True])
def test_bitmaps_over_many_blocks(spark, tmp_path, monkeypatch, shuffled):
    monkeypatch.setattr(store_plan, "BLOCK", 64)
    if shuffled:
        monkeypatch.setattr(store_plan, "BITMAPS_BROADCAST", 0)
    batch = [("a", n, f"u{n:04}", "t", "t", ["x", f"w{n % 5}"], ["l"]) for n in range(500)]
    again = [("b", n, f"u{n:04}", "t", "t", ["y"], None) for n in range(0, 500, 3)]
    store = IndexStore(spark, str(tmp_path / "index"))
    store.append(build_index(pages(spark, batch), None), done(spark, "f0"))
    store.append(build_index(pages(spark, again), None), done(spark, "f1"))
    assert as_dict(store.read()) == brute_force([batch, again])


def test_shared_folder_creates_once(spark, tmp_path):
    folder = SharedFolder(spark, str(tmp_path / "x"))
    assert folder.entries("v") == {}
    with ThreadPoolExecutor(8) as pool:
        made = list(pool.map(lambda n: folder.create("v/1.json", f"é{n}" * 5000), range(8)))
    assert made.count(True) == 1 and folder.read("v/1.json") == f"é{made.index(True)}" * 5000
    assert list(folder.entries("v")) == ["1.json"] and abs(folder.entries("v")["1.json"] / 1000 - time.time()) < 60
    folder.remove("v")
    assert folder.entries("v") == {}


def test_audit_of_segments_adds_up_to_the_whole(spark, tmp_path):
    store = IndexStore(spark, str(tmp_path / "index"))
    for number, batch in enumerate(BATCHES):
        store.append(build_index(pages(spark, batch), lemmas(spark)), done(spark, f"f{number}"))
    bad = build_index(pages(spark, [("q", 0, "u8", "t", "t", ["odd"], ["l1"])]), None)
    bad.postings = bad.postings.unionByName(bad.postings).unionByName(spark.createDataFrame([("unheard", "u77", 1)], bad.postings.schema))
    bad.websites = bad.websites.withColumn("title", F.lit(None).cast("string"))
    bad.links = bad.links.unionByName(spark.createDataFrame([("u78", "l2")], bad.links.schema))
    store.append(bad, done(spark, "q"))
    whole = {r.check: r.violations for r in store.audit().collect()}
    assert {c: n for c, n in whole.items() if n} == {
        "postings unique": 1, "postings.word known": 1, "postings.url known": 1, "links.source_url known": 1, "websites.title not null": 1,
    }
    parts = [store.audit(s["id"]).collect() for s in store.current()["segments"]]
    assert {r.check: sum(x.violations for part in parts for x in part if x.check == r.check) for r in parts[0]} == whole
