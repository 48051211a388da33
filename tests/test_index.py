"""Index building, merging, storage and audits against brute force."""

from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from webloom import build_index, merge_index
from webloom.operators.audit import audit_fk, audit_index, audit_not_null, audit_unique
from webloom.operators.ledger import mark_processed, pending_files, seed_ledger
from webloom.operators.merge import dense_ids, insert_if_absent, replace_children, upsert
from webloom.plans import index as index_plan
from webloom.plans.index import latest_pages, recompute_keywords
from webloom.session import checked_lookup, lookup_join

PAGE = "file_id string, record_no long, url string, title string, description string, tokens array<string>, links array<string>"
LONG, LONGER = "k" * 40, "k" * 41
CRAWL = [
    ("a", 0, "u1", "t", "t", ["old", "both", "both"], ["l0"]),
    ("a", 1, "u1", "T", "T", ["both", "new", "is"], ["l1", "l1", "l2"]),  # replaces the row above
    ("a", 2, "u2", "t2", "t2", ["both", LONG, LONGER, "was"], None),
    ("b", 0, "u2", "t3", "t3", ["both"], ["l9"]),  # same page in a later archive
    ("b", 1, "u3", None, None, ["lost"], ["lost"]),  # no title: not indexed
    ("b", 2, "u4", "", "", [], None),
    ("b", 3, None, "x", "x", ["lost"], None),
]
LEMMAS = {"is": "be", "was": "be"}


def pages(spark, rows=CRAWL):
    return spark.createDataFrame(rows, PAGE)


def lemmas(spark):
    return spark.createDataFrame(list(LEMMAS.items()), "word string, lemma string")


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def brute_force(batches):
    """The four tables by the plain rules, archive by archive."""
    sites, postings, links, parts = {}, {}, {}, {}
    for rows in batches:
        documents = defaultdict(set)
        for file_id, _, url, title, description, words, targets in sorted(
            (r for r in rows if None not in (r[2], r[3], r[4])), key=lambda r: (r[0], r[1])
        ):
            keys = [LEMMAS.get(w, w)[:40] for w in words]
            for key in keys:
                documents[file_id, key].add(url)
            sites[url] = (title, description, len(words))
            postings[url] = Counter(keys)
            links[url] = set(targets or [])
        parts |= {key: len(urls) for key, urls in documents.items()}
    totals = Counter()
    for (_, word), n in parts.items():
        totals[word] += n
    return {
        "websites": sorted((u, *v) for u, v in sites.items()),
        "keywords": sorted(totals.items()),
        "postings": sorted((w, u, n) for u, c in postings.items() for w, n in c.items()),
        "links": sorted((u, t) for u, ts in links.items() for t in ts),
    }


def as_dict(index):
    return {
        "websites": rows(index.websites.select("url", "title", "description", "word_count")),
        "keywords": rows(index.keywords.select("word", "documents_containing_word")),
        "postings": rows(index.postings.select("word", "url", "keyword_occurrences")),
        "links": rows(index.links.select("source_url", "target_website")),
    }


@pytest.mark.parametrize("bound", [1_000_000, 0])
def test_build_index(spark, monkeypatch, bound):
    monkeypatch.setattr(index_plan, "REPEATED_URLS_BROADCAST", bound)  # 0: the shuffling path
    assert as_dict(build_index(pages(spark), lemmas(spark))) == brute_force([CRAWL])


def test_words_made_equal_by_the_limit_are_counted_together(spark):
    found = build_index(pages(spark), lemmas(spark)).postings.filter(F.col("word") == LONG)
    assert rows(found) == []  # u2 was replaced by a later archive
    only_a = pages(spark).filter("file_id = 'a'")
    assert rows(build_index(only_a, lemmas(spark)).postings.filter(F.col("word") == LONG)) == [(LONG, "u2", 2)]


def test_one_url_with_a_third_of_all_rows(spark):
    crawl = [("a", n, "hot" if n % 3 == 0 else f"u{n}", "t", "t", ["w", f"w{n}"], ["l"]) for n in range(3000)]
    assert as_dict(build_index(pages(spark, crawl), None)) == brute_force([crawl])


def test_merge_replaces_pages_and_is_idempotent(spark, tmp_path):
    first = [r for r in CRAWL if r[0] == "a"]
    second = [
        ("b", 0, "u2", "t3", "t3", ["fresh"], ["l9"]),
        ("b", 1, "u1", "T", "T", [], None),  # lost all words and links
        ("b", 2, "u5", "t5", "t5", ["both"], ["l1"]),
    ]
    old, new = (build_index(pages(spark, batch), lemmas(spark)) for batch in (first, second))
    merged = merge_index(old, new)
    assert as_dict(merged) == brute_force([first, second])
    assert as_dict(merge_index(merged, new)) == as_dict(merged)
    assert rows(recompute_keywords(merged.postings)) == sorted(
        Counter(w for w, _, _ in as_dict(merged)["postings"]).items()
    )


def test_postings_do_not_depend_on_the_split_into_archives(spark):
    crawl = [("a", n, f"u{n}", "t", "t", [f"w{n % 7}", "x", "x"], [f"l{n % 5}"]) for n in range(60)]
    whole = build_index(pages(spark, crawl), None)
    split = build_index(pages(spark, [(f"f{r[1] % 4}", *r[1:]) for r in crawl]), None)
    assert as_dict(whole) == as_dict(split)
    assert sum(n for _, _, n in rows(whole.postings)) == sum(r[3] for r in rows(whole.websites))
    assert rows(recompute_keywords(whole.postings)) == rows(whole.keywords)


def test_latest_pages(spark):
    found = latest_pages(pages(spark).dropna(subset=["url"])).select("url", "file_id", "record_no")
    assert rows(found) == [("u1", "a", 1), ("u2", "b", 0), ("u3", "b", 1), ("u4", "b", 2)]


def test_audits_find_what_is_wrong(spark):
    index = build_index(pages(spark), lemmas(spark))
    clean = audit_index(index.websites, index.keywords, index.postings, index.links)
    assert {r.violations for r in clean.collect()} == {0}
    bad = audit_index(
        index.websites.unionByName(index.websites), index.keywords.filter("word <> 'be'"), index.postings,
        index.links.withColumn("source_url", F.lit("gone")).withColumn("target_website", F.lit(None).cast("string")),
    )
    found = {r.check: r.violations for r in bad.collect() if r.violations}
    assert found == {
        "websites.url unique": 3, "postings.word known": 1, "links unique": 1, "links.source_url known": 3,
        "links.target_website not null": 3,
    }


def test_single_audits(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (None, None)], "k int, v string")
    assert rows(audit_unique(df, ["k"])) == [(1, 2)]
    assert rows(audit_fk(df.select("k"), spark.createDataFrame([(1,)], "p int"), "k", "p")) == [(2,)]
    assert rows(audit_not_null(df, ["k", "v"])) == [("k", 1), ("v", 2)]


def test_merge_operators(spark):
    old = spark.createDataFrame([(1, "o"), (2, "o")], "k int, v string")
    new = spark.createDataFrame([(2, "n"), (3, "n")], "k int, v string")
    assert rows(upsert(old, new, ["k"])) == [(1, "o"), (2, "n"), (3, "n")]
    assert rows(insert_if_absent(old, new.unionByName(new), ["k"])) == [(1, "o"), (2, "o"), (3, "n")]
    emptied = spark.createDataFrame([(1,), (2,)], "k int")
    assert rows(replace_children(old, new.filter("k = 2"), emptied, ["k"])) == [(2, "n")]


@pytest.mark.parametrize("max_rows", [100, 0])
def test_lookup_join_keeps_every_row_once(spark, max_rows):
    hot = [("hot", n) for n in range(300)] + [(f"k{n}", n) for n in range(50)] + [(None, 1)]
    left = spark.createDataFrame(hot, "k string, n int")
    lookup = checked_lookup(spark.createDataFrame([("hot", 1), ("k3", 2), ("other", 3)], "k string, v int"), max_rows)
    assert lookup.small == (max_rows > 0)
    joined = lookup_join(left, lookup, "k")
    found = sorted((str(r.k), r.n, r.v) for r in joined.collect())
    assert found == sorted((str(k), n, {"hot": 1, "k3": 2}.get(k)) for k, n in hot)
    if not lookup.small:
        spread = joined.groupBy(F.pmod(F.xxhash64("n"), F.lit(8))).count()
        assert spread.count() == 8


@pytest.mark.parametrize("keys_per_bucket", [100_000, 50, 5])
def test_dense_ids_have_no_gaps(spark, keys_per_bucket):
    words = spark.range(5000).select(F.concat(F.lit("w"), F.col("id") % 1234).alias("word"))
    ids = rows(dense_ids(words, "word", keys_per_bucket=keys_per_bucket).select("id", "word"))
    assert [i for i, _ in ids] == list(range(1, 1235))
    assert len({w for _, w in ids}) == 1234


def test_ledger(spark):
    paths = spark.createDataFrame([("a",), ("b",), ("a",)], "file_name string")
    ledger = seed_ledger(paths)
    assert rows(ledger) == [("a", False), ("b", False)]
    more = spark.createDataFrame([("b",), ("c",)], "file_name string")
    assert rows(seed_ledger(more, ledger)) == rows(ledger)  # a changed list has no effect
    grown = seed_ledger(more, ledger, refresh=True)
    assert rows(grown) == [("a", False), ("b", False), ("c", False)]
    done = mark_processed(grown, spark.createDataFrame([("b",), ("zz",)], "file_name string"))
    assert rows(done) == [("a", False), ("b", True), ("c", False)]
    unknown = spark.createDataFrame([("n", None), ("f", False), ("t", True)], "file_name string, processed boolean")
    assert rows(pending_files(unknown)) == [("f",)]


def test_hot_key_is_dealt_over_tasks_and_nulls_stay_put(spark):
    rows = spark.range(0, 30_000).selectExpr("CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 3 = 1 THEN NULL ELSE 'k' || id END AS k", "id")
    table = spark.range(0, 30_000).selectExpr("'k' || id AS k", "id AS v").union(spark.createDataFrame([("hot", 7)], "k string, v bigint"))
    lookup = checked_lookup(table, 10)
    assert not lookup.small
    joined = lookup_join(rows, lookup, "k", rows_per_task=500)
    found = joined.collect()
    assert len(found) == 30_000 and all((r.v == 7) if r.k == "hot" else r.v is None if r.k is None else r.v == r.id for r in found)
    names = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")
    before = {name: spark.conf.get(name) for name in names}
    for name, value in zip(names, ("64", "false", "-1")):
        spark.conf.set(name, value)
    try:
        again = lookup_join(rows, lookup, "k", rows_per_task=500)
        tasks = again.filter("k = 'hot'").groupBy(F.spark_partition_id()).count().count()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert tasks > 8
