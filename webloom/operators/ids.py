"""Surrogate ids that outlive a batch."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webloom.operators.merge import dense_ids
from webloom.session import Lookup, checked_lookup, lookup_join
from webloom.sources.folder import SharedFolder

IDS_BROADCAST = 1_000_000
MOST_PARTS = 8


class StableIds:
    """A stored table ``(key, id)`` that grows: a key keeps the id that it got first, and no id is given twice.

    Only keys that the table lacks get new ids: they are numbered inside hash buckets, from the highest id so far on.
    A batch of ids counts once its list is created under the next number; a writer whose number was
    taken looks up its keys again, as the other one may have added them. An attempt that fails
    adds nothing. Null keys get no id. Small parts are folded into larger ones, so a row is written a number of times that grows
    with the logarithm of the table.
    """

    def __init__(self, spark: SparkSession, root: str, key: str):
        self.spark, self.key = spark, key
        self.folder = SharedFolder(spark, root)

    def _head(self) -> dict:
        names = self.folder.entries("lists")
        return json.loads(self.folder.read(f"lists/{max(names)}")) if names else {"number": 0, "next": 1, "parts": [], "type": "string"}

    def _commit(self, head: dict, **changed) -> bool:
        made = head | changed | {"number": head["number"] + 1}
        return self.folder.create(f"lists/{made['number']:010}.json", json.dumps(made))

    def _read(self, head: dict, parts: list | None = None) -> DataFrame:
        schema = f"`{self.key}` {head['type']}, id bigint"
        paths = [self.folder.path(p["path"]) for p in (head["parts"] if parts is None else parts)]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def known(self) -> DataFrame:
        return self._read(self._head())

    def extend(self, keys: DataFrame) -> int:
        """Give an id to every key that has none. Returns how many are new."""
        keys = keys.select(self.key).filter(F.col(self.key).isNotNull()).distinct()
        while True:
            head = self._head() | {"type": keys.schema[self.key].dataType.simpleString()}
            path = f"parts/{uuid.uuid4().hex}"
            fresh = keys
            if head["parts"]:
                fresh = lookup_join(keys, checked_lookup(self._read(head), IDS_BROADCAST), self.key).filter("id IS NULL").select(self.key)
            # stored before it is numbered, as numbering passes over it more than once
            fresh.write.parquet(self.folder.path(f"{path}-keys"))
            fresh = self.spark.read.schema(fresh.schema).parquet(self.folder.path(f"{path}-keys"))
            count = fresh.count()
            if count:
                start = head["next"] - 1
                numbered = dense_ids(fresh, self.key).withColumn("id", F.col("id") + start)
                numbered.write.parquet(self.folder.path(path))
            self.folder.remove(f"{path}-keys")
            if not count:
                return 0
            if self._commit(head, next=head["next"] + count, parts=[*head["parts"], {"path": path, "rows": count}]):
                self._fold()
                return count
            self.folder.remove(path)

    def _fold(self) -> None:
        """Write the last parts as one if there are many: all from the first that is smaller than those after it."""
        head = self._head()
        parts = head["parts"]
        if len(parts) <= MOST_PARTS:
            return
        at = next(n for n in range(len(parts)) if n == len(parts) - 2 or parts[n]["rows"] <= sum(p["rows"] for p in parts[n + 1 :]))
        path = f"parts/{uuid.uuid4().hex}"
        rows = sum(p["rows"] for p in parts[at:])
        tasks = max(1, -(-rows // 2_000_000))
        self._read(head, parts[at:]).repartition(tasks, self.key).write.parquet(self.folder.path(path))
        if not self._commit(head, parts=[*parts[:at], {"path": path, "rows": rows}]):
            self.folder.remove(path)  # another writer was first and may fold

    def lookup(self) -> Lookup:
        """For ``lookup_join`` by the key."""
        return checked_lookup(self.known(), IDS_BROADCAST)
