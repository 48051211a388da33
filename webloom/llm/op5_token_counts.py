"""Token counts as rollups that signed changes keep up to date.

Totals of documents and tokens by source, language and tokenizer version are sums, so an
inserted document adds its counts, a deleted one subtracts them, and a revised one does both. A
batch of changes is counted, summed by key and written as one folder of deltas, then named
in the list of commits; totals are the sum of the deltas of committed batches. A batch that
was committed is never written again, and one that was interrupted is written anew from the
start, so a batch counts once however often it is run.

Tokens are counted by a public byte-pair vocabulary, whose file is a parameter; its content
is sent to the tasks, so executors need no copy. The vocabulary has a fixed size.

Scale: each batch is one scan with sums in every task before anything moves; keys
are sources times languages times versions, so a source with a third of all rows is one row per
task. ``compact`` folds committed deltas into one. One writer per store at a time.

Null texts have no tokens but count as documents; null sources and languages are keys of their
own. Rows that repeat count each. Documents are not remembered: whoever deletes one under two batch names subtracts it twice. An empty batch is committed and changes nothing. Columns
other than those named are not read.
"""

from __future__ import annotations

import base64
import uuid
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webloom.llm.storage import join_checked, stored

KEY = ("source", "lang", "tokenizer")
TOTALS = ("documents", "tokens")
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: how this public vocabulary cuts a text before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_DELTA = "source string, lang string, tokenizer string, documents bigint, tokens bigint"


class Tokenizer:
    """A named tokenizer version, of a file with a base64 token and its rank on each line."""

    def __init__(self, version: str, path: str = VOCABULARY, pattern: str = PATTERN):
        self.version, self.pattern = version, pattern
        with open(path, "rb") as file:
            self.content = file.read()

    def encoder(self):
        import tiktoken

        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, self.content.splitlines())}
        return tiktoken.Encoding(self.version, pat_str=self.pattern, mergeable_ranks=ranks, special_tokens={})


def counted(docs: DataFrame, tokenizer: Tokenizer, sign: int = 1) -> DataFrame:
    """Signed totals by key of ``docs`` (source, lang, text), one row per key and task."""
    shared = docs.sparkSession.sparkContext.broadcast(tokenizer)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, totals = shared.value.encoder(), {}
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("source", "lang", "text")), strict=True)
            for source, lang, text in rows:
                total = totals.setdefault((source, lang), [0, 0])
                total[0] += sign
                total[1] += sign * len(encoder.encode_ordinary(text)) if text else 0
        keys = list(totals)
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()),
             pa.array([shared.value.version] * len(keys), pa.string()),
             pa.array([totals[k][0] for k in keys], pa.int64()), pa.array([totals[k][1] for k in keys], pa.int64())],
            [*KEY, *TOTALS],
        )

    return docs.select(*[F.col(c).cast("string").alias(c) for c in ("source", "lang", "text")]).mapInArrow(count, _DELTA)


def inserted(docs: DataFrame, tokenizer: Tokenizer) -> DataFrame:
    return counted(docs, tokenizer)


def deleted(docs: DataFrame, tokenizer: Tokenizer) -> DataFrame:
    """``docs`` as they were counted."""
    return counted(docs, tokenizer, -1)


def revised(before: DataFrame, after: DataFrame, tokenizer: Tokenizer) -> DataFrame:
    return counted(before, tokenizer, -1).unionByName(counted(after, tokenizer))


def _summed(deltas: DataFrame) -> DataFrame:
    return deltas.groupBy(*KEY).agg(*[F.sum(t).alias(t) for t in TOTALS])


class Rollup:
    """Totals under a folder that the cluster shares."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _commits(self) -> list:
        """Rows ``(batch, folder, number)`` in their order: one short row per batch, and again for each time it was folded."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/commits")
        if not path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path):
            return []
        rows = self.spark.read.schema("batch string, folder string, number bigint").parquet(f"{self.folder}/commits").collect()
        return sorted(rows, key=lambda r: r.number)

    def _committed(self) -> dict[str, str]:
        """Folder of deltas of each committed batch: the last that it was written or folded to."""
        return {r.batch: r.folder for r in self._commits()}

    def _commit(self, names: dict[str, str]) -> None:
        start = max((r.number for r in self._commits()), default=-1) + 1
        rows = [(batch, folder, start + i) for i, (batch, folder) in enumerate(names.items())]
        self.spark.createDataFrame(rows, "batch string, folder string, number bigint").coalesce(1).write.mode(
            "append"
        ).parquet(f"{self.folder}/commits")

    def apply(self, batch: str, *deltas: DataFrame) -> bool:
        """Apply a batch once; False if it was committed before."""
        if batch in self._committed():
            return False
        folder = f"deltas/{batch}"
        changes = reduce(DataFrame.unionByName, deltas) if deltas else self.spark.createDataFrame([], _DELTA)
        _summed(changes).write.mode("overwrite").parquet(f"{self.folder}/{folder}")
        self._commit({batch: folder})
        return True

    def totals(self) -> DataFrame:
        """Documents and tokens by source, language and tokenizer; keys of which nothing is left are gone."""
        folders = sorted({f for f in self._committed().values() if f})
        if not folders:
            return self.spark.createDataFrame([], _DELTA)
        deltas = self.spark.read.schema(_DELTA).parquet(*[f"{self.folder}/{f}" for f in folders])
        return _summed(deltas).filter((F.col("documents") != 0) | (F.col("tokens") != 0))

    def compact(self, name: str) -> None:
        """Fold the deltas of all committed batches into one folder; batches stay known."""
        known = self._committed()
        if not known:
            return
        folder = f"base/{name}-{uuid.uuid4().hex}"  # never one that totals are read from
        self.totals().write.parquet(f"{self.folder}/{folder}")
        # one append moves all batches to the folded totals
        self._commit({batch: folder for batch in known})


def strip_marks(docs: DataFrame) -> DataFrame:
    """The revision of the query: runs of marks behind words are removed."""
    return docs.withColumn("text", F.regexp_replace("text", r"[!*#%&$]{2,}", ""))


def rollup_of(docs: DataFrame, labels: DataFrame, folder: str, tokenizer: Tokenizer) -> DataFrame:
    """All documents inserted, those of low quality revised, toxic ones deleted; each batch is
    applied twice, as a repeated run would, and counts once."""
    store = Rollup(docs.sparkSession, folder)
    docs = docs.select("doc_id", "source", "lang", "text")
    marks = labels.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
    # only the labels that change something are joined: texts of other documents do not move
    marks = stored(marks.filter("quality = 0 OR toxic = 1"))
    labelled = join_checked(docs, marks, ["doc_id"])
    low = labelled.filter("quality = 0 AND coalesce(toxic, 0) <> 1")
    for _ in range(2):
        store.apply("load", inserted(docs, tokenizer))
        store.apply("revise", revised(low, strip_marks(low), tokenizer))
        store.apply("delete", deleted(labelled.filter("toxic = 1"), tokenizer))
    return store.totals()
