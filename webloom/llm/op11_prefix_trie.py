"""Prefix trie of conversations, by union-find over the LCP edges of sorted neighbours.

A conversation is the sequence of the digests of its turns (128 bits of SHA-256 of role and text, in hexadecimal, so that
sequences sort as strings). Equal sequences are one row with their members counted. Rows are range-partitioned
by sequence; within a partition, neighbours are joined by edges whose depth is the number of turns they have in common.
Edges are taken in descending depth and components merged: every merge makes a branching node, or adds
a child to the one that the left component already has at that depth, and the nodes between a component's top and the merge form a
chain with one child each. What lies deeper than the common prefix with the neighbouring partitions is final.
The rest, the nodes on a partition's left and right border, is contracted to one row per node, named by the
digest of its prefix, and the rows of all partitions are added up by name. A node that began in an earlier partition is owned
there, so it is counted once, and each sum is additive.

Scale: one shuffle places turns, one brings the copied first turns, one sequences. A partition holds about
``TURNS`` turns of distinct sequences however many copies there are. The ids of the conversations that end in a
node are joined to strings by blocks of ``IDS`` ids and hashed as a stream, block by block, so a sequence
that a third of all conversations share is neither collected nor held. Only the borders of partitions, two
sequences each, meet in one task. A conversation is one row of 32 bytes a turn.

Null roles and texts are empty; null turns come first, rows of equal turn are ordered by role, then text, and
equal rows each count. Rows without a conversation id are left out. Conversations with
turns of others only, or none, are members like all. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from webloom.llm.storage import stored
from webloom.session import checked_lookup, lookup_join

WIDTH = 32  # characters of a turn's digest
TURNS = 200_000  # of a partition
IDS = 65_536  # range of ids joined at once
BORDER_NODES = 1_000_000  # broadcast up to this counted number
NOTHING = hashlib.sha256(b"").hexdigest()


# --- conversations as sequences --------------------------------------------------------------


def sequences(conversations: DataFrame) -> DataFrame:
    """``conv_id, seq, words``: digests of the turns in order, and the words of each turn's text."""
    rows = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )
    # the role's length in front tells role and text apart
    named = F.concat(F.char_length("role").cast("string"), F.lit(":"), "role", "text")
    rows = rows.select(
        "conv_id", "turn", "role", F.substring(F.sha2(named.cast("binary"), 256), 1, WIDTH).alias("digest"),
        F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint").alias("words"), F.col("text"),
    )
    order = W.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    placed = rows.withColumn("pos", F.row_number().over(order))
    all_turns = F.sort_array(F.collect_list(F.struct("pos", "digest", "words")))
    return placed.groupBy("conv_id").agg(all_turns.alias("t")).select(
        "conv_id", F.array_join("t.digest", "").alias("seq"), F.col("t.words").alias("words")
    )


def with_copied_starts(seqs: DataFrame, every: int = 20, most: int = 3) -> DataFrame:
    """Each conversation c begins with the first h turns of conversation ``c - c % every``, where h is the CRC-32 of
    c in decimals modulo ``most + 1``, and goes on with its own turns after its first h."""
    heads = seqs.filter(F.col("conv_id") % every == 0).select(
        F.col("conv_id").alias("host"), F.substring("seq", 1, most * WIDTH).alias("head"),
        F.slice("words", 1, most).alias("head_words"),
    )
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % (most + 1)
    rows = seqs.withColumns({"host": F.col("conv_id") - F.col("conv_id") % every, "h": h.cast("int")})
    joined = rows.join(heads, "host", "left")
    none = F.array().cast("array<bigint>")
    return joined.select(
        "conv_id",
        F.concat(
            F.expr(f"substring(coalesce(head, ''), 1, {WIDTH} * h)"), F.expr(f"substring(seq, {WIDTH} * h + 1)")
        ).alias("seq"),
        F.concat(
            F.coalesce(F.slice("head_words", F.lit(1), F.col("h")), none),
            F.slice("words", F.col("h") + 1, F.greatest(F.size("words"), F.lit(1))),
        ).alias("words"),
    )


def distinct_sequences(seqs: DataFrame) -> DataFrame:
    """``seq, words, conv, members, ends``: each sequence with its least id, number and digest of ids."""
    blocks = seqs.withColumns({"key": F.sha2(F.col("seq").cast("binary"), 256), "block": F.floor(F.col("conv_id") / IDS)})
    blocks = blocks.groupBy("key", "block").agg(
        F.first("seq").alias("seq"), F.first("words").alias("words"), F.min("conv_id").alias("conv"),
        F.count(F.lit(1)).alias("members"), F.sort_array(F.collect_list("conv_id")).alias("ids"),
    ).withColumn("ids", F.array_join(F.col("ids").cast("array<string>"), ","))
    # sorted by key and block within a task, so that a sequence's blocks follow each other
    ordered = blocks.repartition("key").sortWithinPartitions("key", "block")
    return ordered.mapInArrow(_digest_ids, "seq string, words array<bigint>, conv bigint, members bigint, ends string")


def _digest_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per run of equal keys; of a run only the state of its digest is held."""
    names = ["seq", "words", "conv", "members", "ends"]
    types = [pa.string(), pa.list_(pa.int64()), pa.int64(), pa.int64(), pa.string()]
    key, run, digest = None, None, None
    for batch in batches:
        done = []
        for row in batch.to_pylist():
            if row["key"] != key:
                if run:
                    done.append([*run, digest.hexdigest()])
                key, digest = row["key"], hashlib.sha256(row["ids"].encode())
                run = [row["seq"], row["words"], row["conv"], row["members"]]
            else:
                digest.update(b"," + row["ids"].encode())
                run[2], run[3] = min(run[2], row["conv"]), run[3] + row["members"]
        if done:
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*done), types)], names)
    if run:
        yield pa.record_batch([pa.array([c], t) for c, t in zip([*run, digest.hexdigest()], types)], names)


# --- the forest of a partition ------------------------------------------------------------------


def common_turns(a: str, b: str) -> int:
    """Turns that two sequences begin with alike."""
    most = min(len(a), len(b)) // WIDTH
    if a[: most * WIDTH] == b[: most * WIDTH]:
        return most
    low, high = 0, most  # a[:low] is alike, a[:high] is not
    while high - low > 1:
        middle = (low + high) // 2
        if a[low * WIDTH : middle * WIDTH] == b[low * WIDTH : middle * WIDTH]:
            low = middle
        else:
            high = middle
    return low


class Forest:
    """Trie nodes over sorted distinct sequences.

    ``left`` and ``right`` are the turns that the first and the last sequence share with the partition before
    and after, -1 without one.
    """

    def __init__(self, seqs: list, words: list, convs: list, members: list, ends: list, left: int, right: int):
        self.seqs, self.words, self.left, self.right = seqs, words, left, right
        self.depth, self.least, self.members, self.kids, self.leaves = [], [], [], [], []
        self.saved, self.ends, self.parent, self.first, self.childless = [], [], [], [], []
        last = len(seqs) - 1
        for i, seq in enumerate(seqs):
            node = self._new(len(seq) // WIDTH, i)
            self.least[node], self.members[node], self.ends[node] = convs[i], members[i], ends[i]
            self.saved[node] += members[i] * self._weight(node)
            # the next partition may go on where the last sequence ends
            open_end = i == last and right >= self.depth[node]
            self.childless[node], self.leaves[node] = not open_end, int(not open_end)
        self._merge()

    def _weight(self, node: int) -> int:
        depth = self.depth[node]
        return self.words[self.first[node]][depth - 1] if depth else 0

    def _owned(self, node: int) -> bool:
        return self.first[node] > 0 or self.depth[node] > self.left

    def _new(self, depth: int, first: int) -> int:
        node = len(self.depth)
        for column, value in (
            (self.depth, depth), (self.least, None), (self.members, 0), (self.kids, 0), (self.leaves, 0), (self.saved, 0),
            (self.ends, None), (self.parent, -1), (self.first, first), (self.childless, False),
        ):
            column.append(value)
        if self._owned(node):
            self.saved[node] = -self._weight(node)
        return node

    def _attach(self, child: int, parent: int) -> None:
        self.parent[child] = parent
        least = self.least[parent]
        self.least[parent] = self.least[child] if least is None else min(least, self.least[child])
        self.members[parent] += self.members[child]
        if self.childless[parent]:
            self.childless[parent], self.leaves[parent] = False, 0
        self.kids[parent] += self._owned(child)
        self.leaves[parent] += self.leaves[child]
        self.saved[parent] += self.saved[child] + self.members[child] * self._weight(parent)

    def _chain(self, node: int, depth: int) -> int:
        """Nodes with one child each, from above ``node`` down to ``depth``; the last of them."""
        for d in range(self.depth[node] - 1, depth - 1, -1):
            above = self._new(d, self.first[node])
            self._attach(node, above)
            node = above
        return node

    def _merge(self) -> None:
        n = len(self.seqs)
        lcps = [common_turns(self.seqs[i - 1], self.seqs[i]) for i in range(1, n)]
        boss, top = list(range(n)), list(range(n))

        def find(i: int) -> int:
            while boss[i] != i:
                boss[i] = boss[boss[i]]
                i = boss[i]
            return i

        # equal depths from left to right: the left component has all that it gets at this depth from its left
        for at in sorted(range(n - 1), key=lambda i: (-lcps[i], i)):
            a, b, depth = find(at), find(at + 1), lcps[at]
            branch = self._chain(top[a], depth)
            self._attach(self._chain(top[b], depth + 1), branch)
            boss[b] = a
            top[a] = branch
        self._chain(top[find(0)], 0)

    def _border(self, node: int, seq: str, depth: int) -> dict[int, str]:
        """Names of the nodes above a border's end, down to what the neighbour may share."""
        keys, digest = [], hashlib.sha256()
        for d in range(depth + 1):
            keys.append(digest.hexdigest())
            digest.update(seq[d * WIDTH : (d + 1) * WIDTH].encode())
        names = {}
        while node >= 0:
            if self.depth[node] <= depth:
                names[node] = keys[self.depth[node]]
            node = self.parent[node]
        return names

    def table(self) -> pa.Table:
        last = len(self.seqs) - 1
        keys = self._border(0, self.seqs[0], self.left) | self._border(last, self.seqs[last], self.right)
        ids = range(len(self.depth))
        return pa.table({
            "conv_id": pa.array(self.least, pa.int64()), "depth": pa.array(self.depth, pa.int64()),
            "parent_conv_id": pa.array([self.least[p] if p >= 0 else None for p in self.parent], pa.int64()),
            "n_convs": pa.array(self.members, pa.int64()), "n_children": pa.array(self.kids, pa.int64()),
            "n_leaves": pa.array(self.leaves, pa.int64()), "saved_tokens": pa.array(self.saved, pa.int64()),
            "ends_sha256": pa.array(self.ends, pa.string()), "key": pa.array([keys.get(i) for i in ids], pa.string()),
            "parent_key": pa.array([keys.get(self.parent[i]) for i in ids], pa.string()),
        })


NODE = (
    "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, "
    "saved_tokens bigint, ends_sha256 string, key string, parent_key string"
)


def _forest(rows: pa.Table) -> pa.Table:
    rows = rows.sort_by("seq")
    columns = [rows[name].to_pylist() for name in ("seq", "words", "conv", "members", "ends")]
    return Forest(*columns, rows["left"][0].as_py(), rows["right"][0].as_py()).table()


@F.pandas_udf(IntegerType())
def _shared(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([-1 if x is None or y is None else common_turns(x, y) for x, y in zip(a, b)])


def trie(seqs: DataFrame, turns: int = TURNS) -> DataFrame:
    """A row per node of the trie of ``conv_id, seq, words``."""
    spark = seqs.sparkSession
    rows = stored(distinct_sequences(stored(seqs)))
    total = rows.agg(F.sum(F.length("seq") / WIDTH + 1)).first()[0]
    if not total:
        return spark.createDataFrame([], NODE).drop("key", "parent_key")
    parts = max(1, int(-(-total // turns)), min(spark.sparkContext.defaultParallelism, int(total // 1000)))
    parted = stored(rows.repartitionByRange(parts, "seq").withColumn("part", F.spark_partition_id()))
    # one row per partition
    borders = parted.groupBy("part").agg(F.min("seq").alias("head"), F.max("seq").alias("tail"))
    line = W.orderBy("part")
    borders = borders.select("part", "head", "tail", F.lag("tail").over(line).alias("before"), F.lead("head").over(line).alias("after"))
    borders = stored(borders.select("part", _shared("before", "head").alias("left"), _shared("tail", "after").alias("right")))
    nodes = stored(parted.join(borders, "part").groupBy("part").applyInArrow(_forest, NODE))

    sums = [F.sum(name).alias(name) for name in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    border = stored(nodes.filter("key IS NOT NULL").groupBy("key", "depth").agg(
        F.min("conv_id").alias("conv_id"), *sums, F.max("ends_sha256").alias("ends_sha256"), F.max("parent_key").alias("parent_key"),
    ))
    every = nodes.filter("key IS NULL").drop("key").unionByName(
        border.drop("key").withColumn("parent_conv_id", F.lit(None).cast("bigint"))
    )
    # nodes under the border take the parent's id from the merged rows
    parents = checked_lookup(border.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("of_border")), BORDER_NODES)
    return lookup_join(every, parents, "parent_key").select(
        "conv_id", "depth", F.coalesce("of_border", "parent_conv_id").alias("parent_conv_id"), "n_convs", "n_children",
        "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(NOTHING)).alias("ends_sha256"),
    )


def trie_report(conversations: DataFrame) -> DataFrame:
    """The trie of all conversations with copied starts."""
    return trie(with_copied_starts(stored(sequences(conversations))))


# CRC-32 bit by bit; a node's key is the digests of its turns, so its ancestors' keys are its beginnings.
SQL = """
WITH own AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos,
    md5(len(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS digest,
    len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS words FROM conversations WHERE conv_id IS NOT NULL),
convs AS (SELECT conv_id, xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: ascii(x)::UBIGINT)),
    lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)::UBIGINT[]), lambda x, i: xor(x >> 1, 3988292384::UBIGINT * (x & 1::UBIGINT)))),
    4294967295::UBIGINT) % 4 AS h FROM (SELECT DISTINCT conv_id FROM own)),
turns AS (SELECT c.conv_id, o.pos, o.digest, o.words FROM convs c JOIN own o ON o.conv_id = c.conv_id - c.conv_id % 20 AND o.pos <= c.h
    UNION ALL SELECT c.conv_id, o.pos + 4, o.digest, o.words FROM convs c JOIN own o ON o.conv_id = c.conv_id AND o.pos > c.h),
prefixes AS (SELECT conv_id, row_number() OVER w AS depth, string_agg(digest, '') OVER w AS key, words FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY pos)
    UNION ALL SELECT conv_id, 0, '', 0 FROM convs),
whole AS (SELECT conv_id, max(depth) AS depth, arg_max(key, depth) AS key FROM prefixes GROUP BY conv_id),
ends AS (SELECT key, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) AS ids FROM whole GROUP BY key),
nodes AS (SELECT key, depth, min(conv_id) AS conv_id, count(*) AS n, min(words) AS words FROM prefixes GROUP BY key, depth),
kids AS (SELECT left(key, (depth - 1) * 32) AS key, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1),
up AS (SELECT left(n.key, 32 * d) AS key, sum((n - 1) * words) AS saved, count(*) FILTER (childless) AS leaves
    FROM (SELECT n.*, k.key IS NULL AS childless, unnest(range(n.depth + 1)) AS d FROM nodes n LEFT JOIN kids k USING (key)) n GROUP BY 1)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n AS n_convs, coalesce(k.n, 0) AS n_children, u.leaves AS n_leaves,
    CAST(u.saved AS BIGINT) AS saved_tokens, sha256(coalesce(e.ids, '')) AS ends_sha256
FROM nodes n JOIN up u USING (key) LEFT JOIN kids k USING (key) LEFT JOIN ends e USING (key)
LEFT JOIN nodes p ON n.depth > 0 AND p.key = left(n.key, (n.depth - 1) * 32)
"""
