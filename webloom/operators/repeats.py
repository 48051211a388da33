"""Keys that occur more than once, found without moving those that occur once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FEWEST_BITS, MOST_BITS = 1 << 16, 1 << 30
BITS_A_ROW = 8
BLOCK_BYTES = 4096
_FILTER = "block bigint, once binary, twice binary"


def _built(bits: int):
    """One filter of a task: bits that are hit, and bits that are hit twice. Blocks without a bit are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice = np.zeros(bits >> 3, np.uint8), np.zeros(bits >> 3, np.uint8)
        for batch in batches:
            at, hits = np.unique(batch["hash"].to_numpy() & (bits - 1), return_counts=True)
            byte, bit = at >> 3, np.left_shift(np.uint8(1), (at & 7).astype(np.uint8))
            again = (hits > 1) | (once[byte] & bit > 0)
            np.bitwise_or.at(twice, byte[again], bit[again])
            np.bitwise_or.at(once, byte, bit)
        once, twice = once.reshape(-1, BLOCK_BYTES), twice.reshape(-1, BLOCK_BYTES)
        for block in np.flatnonzero(once.any(axis=1)):
            yield pa.record_batch(
                [pa.array([block], pa.int64()), pa.array([once[block].tobytes()]), pa.array([twice[block].tobytes()])], ["block", "once", "twice"]
            )

    return run


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Filters of all tasks, sorted by block: a bit hit in two of them is hit twice."""
    at, once, twice = None, None, None

    def row() -> pa.RecordBatch:
        return pa.record_batch([pa.array([at], pa.int64()), pa.array([twice.tobytes()])], ["block", "twice"])

    for batch in batches:
        for block, a, b in zip(*(batch[name] for name in ("block", "once", "twice"))):
            a, b = (np.frombuffer(x.as_buffer(), np.uint8) for x in (a, b))
            if block.as_py() != at:
                if at is not None and twice.any():
                    yield row()
                at, once, twice = block.as_py(), a.copy(), b.copy()
            else:
                twice |= b | (once & a)
                once |= a
    if at is not None and twice.any():
        yield row()


def may_repeat(rows: DataFrame, key: str, bits: int) -> DataFrame:
    """Rows whose key may occur more than once: all that do, and few others.

    A first pass builds a filter per task from the keys' hashes and merges them block by block; only blocks of
    bits move. The bits that were hit twice, at most ``bits / 8`` bytes, are broadcast, and a second pass drops rows without one
    where they lie. Null keys are dropped.
    """
    hashed = rows.filter(F.col(key).isNotNull()).withColumn("_hash", F.xxhash64(key))
    built = hashed.select(F.col("_hash").alias("hash")).mapInArrow(_built(bits), _FILTER)
    merged = built.repartition("block").sortWithinPartitions("block").mapInArrow(_merged, "block bigint, twice binary")
    twice = np.zeros(bits >> 3, np.uint8)
    for block, data in merged.toLocalIterator():  # at most bits / 8 bytes
        twice[block * BLOCK_BYTES : (block + 1) * BLOCK_BYTES] = np.frombuffer(data, np.uint8)
    shared = rows.sparkSession.sparkContext.broadcast(twice)

    @F.pandas_udf("boolean")
    def hit(hashes):
        at = hashes.to_numpy() & (bits - 1)
        return hashes.__class__(shared.value[at >> 3] >> (at & 7).astype(np.uint8) & 1 > 0)

    return hashed.filter(hit("_hash")).drop("_hash")


def repeated_keys(rows: DataFrame, key: str, order: tuple[str, ...], count: int | None = None, filter_from: int = 5_000_000) -> DataFrame:
    """``(key, _last)`` of every key of several rows, with the greatest ``order`` of them.

    From ``filter_from`` rows on, only rows that may repeat are grouped, so what is shuffled grows with the repeats and not
    with the rows. A filter that all rows would fill is not built.
    """
    count = rows.count() if count is None else count
    rows = rows.select(key, *order).filter(F.col(key).isNotNull())
    if filter_from <= count <= MOST_BITS:
        rows = may_repeat(rows, key, min(MOST_BITS, max(FEWEST_BITS, 1 << (count * BITS_A_ROW - 1).bit_length())))
    versions = rows.groupBy(key).agg(F.max(F.struct(*order)).alias("_last"), F.count(F.lit(1)).alias("_versions"))
    return versions.filter(F.col("_versions") > 1).select(key, "_last")
