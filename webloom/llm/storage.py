"""Tables kept between jobs, and lookups of checked size."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_ROWS = 2_000_000  # most rows of a table that is broadcast; larger ones are joined by shuffle
ARROW_BATCH_BYTES = 4 << 20

_local: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a temporary one only where it is unset in local mode."""
    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the whole cluster shares")
    app = spark.sparkContext.applicationId
    if app not in _local:
        _local[app] = tempfile.mkdtemp(prefix="webloom-llm-")
    return _local[app]


def stored(df: DataFrame) -> DataFrame:
    """Write a table to the shared folder and read it back: later jobs do not repeat its work,
    and an executor that is lost takes nothing with it."""
    path = f"{shared_folder(df.sparkSession)}/llm-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bounded_batches(spark: SparkSession) -> None:
    """Texts may be very long: bound Arrow batches by bytes as well as rows."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BATCH_BYTES))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4000")


def small(table: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """Whether a table of narrow rows is small enough to be broadcast, found by counting it."""
    return table.count() <= rows


def join_checked(
    left: DataFrame, right: DataFrame, on: list[str], how: str = "inner", most: int = BROADCAST_ROWS
) -> DataFrame:
    """Join with ``right`` broadcast if its counted rows allow, by shuffle otherwise. The rows are the same."""
    return left.join(F.broadcast(right) if small(right, most) else right, on, how)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread_scan(df: DataFrame) -> DataFrame:
    """A table in fewer files than there are cores is dealt out, so that costly work uses them all."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
