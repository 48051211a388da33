"""Session settings, the shared scratch folder and joins with lookup tables."""

from __future__ import annotations

import tempfile
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType

# What the jobs here want from a session. Each is a plain Spark setting, so a
# cluster's own values win when they are set there.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Pages vary from bytes to megabytes: bound Arrow batches by size, not rows.
    "spark.sql.execution.arrow.maxBytesPerBatch": str(64 << 20),
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
}

_local_scratch: dict[str, str] = {}


def scratch_dir(spark: SparkSession) -> str:
    """Folder all executors can reach: the cluster's ``spark.checkpoint.dir``."""
    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    app = spark.sparkContext.applicationId
    if shared:
        return f"{shared.rstrip('/')}/webloom-{app}"
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    if app not in _local_scratch:
        _local_scratch[app] = tempfile.mkdtemp(prefix="webloom-")
    return _local_scratch[app]


def spread(df: DataFrame) -> DataFrame:
    """Give costly per-row work enough tasks when a scan has only a few.

    Meant for plain scans: a table with a partition for every core, which any
    large one has, is left as it is and does not shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


@dataclass(frozen=True)
class Lookup:
    """Rows with a unique key to join from, and whether they were found small."""

    rows: DataFrame
    small: bool


def checked_lookup(rows: DataFrame, max_rows: int, max_bytes: int = 256 << 20) -> Lookup:
    """Measure rows and bytes of a lookup table.

    The check is one aggregate, so a large table sends no more than a sum per task.
    """
    sizes = [F.coalesce(F.octet_length(F.col(name).cast("string")), F.lit(0)) for name in rows.columns]
    count, data = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(sum(sizes, F.lit(0).cast("long"))), F.lit(0))).first()
    return Lookup(rows, count <= max_rows and data <= max_bytes)


def lookup_join(rows: DataFrame, lookup: Lookup, key: str, rows_per_task: int = 1_000_000) -> DataFrame:
    """Left join with a lookup table; every row is kept and none is doubled.

    A table of checked size is broadcast and ``rows`` do not shuffle. For a larger one,
    rows are counted by key first: a key with more than ``rows_per_task`` of them is dealt over
    as many tasks as that takes, its row of the table copied for each. There are at most as
    many such keys as tasks. NULL keys match nothing and do not shuffle.
    """
    if lookup.small:
        return rows.join(F.broadcast(lookup.rows), key, "left")
    keyed = rows.filter(F.col(key).isNotNull())
    counts = keyed.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > rows_per_task)
    hot = {r[0]: -(-r[1] // rows_per_task) for r in counts.collect()}
    if hot:
        schema = f"`{key}` {rows.schema[key].dataType.simpleString()}, _copies long"
        hot = rows.sparkSession.createDataFrame(list(hot.items()), schema)
        copies = F.coalesce("_copies", F.lit(1).cast("long"))
        # by what is in the row, so a task that runs again after a lost executor deals its rows alike
        own = [name for name, kind in rows.dtypes if not kind.startswith("map")]
        dealt = keyed.join(F.broadcast(hot), key, "left").withColumn(
            "_salt", F.pmod(F.xxhash64(F.spark_partition_id(), *own), copies)
        )
        copied = lookup.rows.join(F.broadcast(hot), key, "left").withColumn(
            "_salt", F.explode(F.sequence(F.lit(0).cast("long"), copies - 1))
        )
        joined = dealt.drop("_copies").join(copied.drop("_copies"), [key, "_salt"], "left").drop("_salt")
    else:
        joined = keyed.join(lookup.rows, key, "left")
    return joined.unionByName(rows.filter(F.col(key).isNull()), allowMissingColumns=True)
