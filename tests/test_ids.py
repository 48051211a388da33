"""Ids that outlive a batch, and keys that repeat."""

from concurrent.futures import ThreadPoolExecutor
from threading import Barrier

import pytest
from pyspark.sql import functions as F

from test_index import rows
from webloom.operators import ids as ids_module
from webloom.operators.ids import StableIds
from webloom.operators.repeats import may_repeat, repeated_keys
from webloom.session import lookup_join
from webloom.sources.folder import SharedFolder


def keys(spark, names):
    return spark.createDataFrame([(n,) for n in names], "k string")


@pytest.mark.parametrize("bound", [1_000_000, 0])
def test_ids_stay_and_do_not_repeat(spark, tmp_path, monkeypatch, bound):
    monkeypatch.setattr(ids_module, "IDS_BROADCAST", bound)  # 0: the shuffling path
    monkeypatch.setattr(ids_module, "MOST_PARTS", 2)
    ids, seen = StableIds(spark, str(tmp_path / "ids"), "k"), {}
    assert ids.known().count() == 0
    for batch in range(5):
        names = [f"k{n}" for n in range(batch * 20, batch * 20 + 50)] + [None, "k1", "k1"]
        new = ids.extend(keys(spark, names))
        known = dict(rows(ids.known()))
        assert len(set(known.values())) == len(known) and all(known[k] == i for k, i in seen.items())
        assert new == len(known) - len(seen) and None not in known
        seen = known
    assert sorted(seen.values()) == list(range(1, 131)) and ids.extend(keys(spark, ["k1"])) == 0
    joined = lookup_join(keys(spark, ["k5", "unknown", None]), ids.lookup(), "k")
    assert {(r.k, r.id) for r in joined.collect()} == {("k5", seen["k5"]), ("unknown", None), (None, None)}


def test_two_writers_give_one_id(spark, tmp_path, monkeypatch):
    root, barrier, tries = str(tmp_path / "ids"), Barrier(2, timeout=60), []
    create = SharedFolder.create

    def together(self, name, text):
        tries.append(name)
        if len(tries) <= 2:
            barrier.wait()
        return create(self, name, text)

    monkeypatch.setattr(SharedFolder, "create", together)
    with ThreadPoolExecutor(2) as pool:
        new = list(pool.map(lambda names: StableIds(spark, root, "k").extend(keys(spark, names)), (["a", "b", "c"], ["b", "c", "d"])))
    known = dict(rows(StableIds(spark, root, "k").known()))
    assert sorted(known) == ["a", "b", "c", "d"] and len(set(known.values())) == 4 and sorted(new) == [1, 3]


def test_failed_batch_gives_no_ids(spark, tmp_path):
    ids = StableIds(spark, str(tmp_path / "ids"), "k")
    ids.extend(keys(spark, ["a"]))
    with pytest.raises(Exception, match="disk gone"):
        ids.extend(keys(spark, ["b"]).withColumn("k", F.raise_error(F.lit("disk gone")).cast("string")))
    assert ids.extend(keys(spark, ["b", "a"])) == 1 and len(rows(ids.known())) == 2


def test_only_what_may_repeat_is_grouped(spark):
    once = spark.range(0, 20_000).selectExpr("'u' || id AS url", "'a' AS file_id", "id AS record_no")
    again = spark.range(0, 300).selectExpr("'u' || id * 7 AS url", "'b' AS file_id", "id AS record_no")
    hot = spark.range(0, 5000).selectExpr("'hot' AS url", "'c' AS file_id", "id AS record_no")
    none = spark.range(0, 50).selectExpr("CAST(NULL AS STRING) AS url", "'c' AS file_id", "id AS record_no")
    rows_ = once.unionByName(again).unionByName(hot).unionByName(none).repartition(7)
    kept = may_repeat(rows_, "url", 1 << 18)
    # all rows of repeated keys, and of 19,700 others about one in fourteen by chance
    assert 5600 <= kept.count() <= 5600 + 2000
    expected = {(f"u{n * 7}", ("b", n)) for n in range(300)} | {("hot", ("c", 4999))}
    for start in (0, 10**9):
        found = repeated_keys(rows_, "url", ("file_id", "record_no"), filter_from=start)
        assert {(r.url, tuple(r._last)) for r in found.collect()} == expected
    assert repeated_keys(rows_.limit(0), "url", ("file_id", "record_no"), filter_from=0).count() == 0
