"""Crawl archives: gzip files of records, one task per file, records streamed.

A gzip archive cannot be split, so the number of files is the parallelism of the
scan and a file is never held in memory: records leave in Arrow batches of
bounded size.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from webloom.sources.members import Members

RECORD_SCHEMA = (
    "file_id string, record_no long, headers map<string,string>, body binary, _corrupt_record string"
)
_ARROW_SCHEMA = pa.schema(
    [
        ("file_id", pa.string()),
        ("record_no", pa.int64()),
        ("headers", pa.map_(pa.string(), pa.string())),
        ("body", pa.binary()),
        ("_corrupt_record", pa.string()),
    ]
)
BATCH_BYTES = 16 << 20
BATCH_ROWS = 1000
_LARGEST_BODY = (1 << 31) - 1 - (1 << 20)  # what one Spark binary value can hold


# Names that Spark and Arrow have for the same file systems.
_SCHEMES = {"s3a": "s3", "s3n": "s3", "s3": "s3", "hdfs": "hdfs", "viewfs": "viewfs", "gs": "gs", "abfss": "abfss", "abfs": "abfs"}


def split_path(path: str) -> tuple[str, str]:
    """Arrow's name of a file's system ("" for the local one) and the path as Arrow takes it.

    Local names are taken as they are, so ``#``, ``?`` and ``%`` in them mean themselves.
    """
    if path.startswith("/"):
        return "", path
    if path.startswith("file:"):
        return "", re.sub(r"^file:/+", "/", path)
    scheme, colon, rest = path.partition("://")
    if not colon or scheme not in _SCHEMES:
        raise ValueError(f"cannot open {path!r}: use a local path or one of {sorted(_SCHEMES)}")
    return _SCHEMES[scheme], f"{_SCHEMES[scheme]}://{rest}"


def open_stream(path: str):
    """Byte stream of a local file or of one on a shared file system."""
    scheme, name = split_path(path)
    if not scheme:
        return open(name, "rb")
    system, inner = fs.FileSystem.from_uri(name)
    return system.open_input_stream(inner)


def iter_records(stream) -> Iterator[tuple[dict | None, bytes | None, str | None]]:
    """``(headers, body, problem)`` per record; header names in lower case.

    A damaged record comes out once, with a problem and no body. Where its length is
    usable its content is passed over, else the scan goes on at the next line that opens a
    record. Behind damaged compression it goes on with the next member. A record waits until the
    bytes behind it are read, as the checksum of a member is known only then.
    """
    in_damage, waiting = False, None
    line = stream.readline()
    while True:
        if not line:
            problem = getattr(stream, "problem", None)
            if waiting and problem and "incorrect" in problem and stream.in_member:
                yield waiting[0], None, problem  # the member's checksum does not fit what it held
            else:
                if waiting:
                    yield waiting
                if problem:
                    yield None, None, problem
            if not problem:
                return
            stream.resume()
            in_damage, waiting = False, None
            line = stream.readline()
            continue
        if not line.strip(b"\r\n"):
            line = stream.readline()
            continue
        if waiting:
            yield waiting
            waiting = None
        if not line.startswith(b"WARC/"):
            if not in_damage:
                in_damage = True
                yield None, None, "not a record: " + line.decode("utf-8", "replace").rstrip()
            line = stream.readline()
            continue
        in_damage = False
        headers, malformed = {}, None
        line = stream.readline()
        while line not in (b"\r\n", b"\n", b""):
            name, colon, value = line.decode("utf-8", "replace").partition(":")
            if not colon:
                malformed = "malformed header: " + name.rstrip()
            headers[name.strip().lower()] = value.strip()
            line = stream.readline()
        if not line and getattr(stream, "problem", None):
            continue  # told of above
        length = headers.get("content-length", "")
        usable = length.isascii() and length.isdecimal()
        if not malformed and not usable:
            malformed = "no usable content length"
        if not malformed and int(length) > _LARGEST_BODY:
            malformed = "body larger than one value can hold"
        if malformed:
            yield headers, None, malformed
            if usable:
                _pass_over(stream, int(length))
            else:
                in_damage = True
        else:
            body = stream.read(int(length))
            if len(body) == int(length):
                waiting = (headers, body, None)
            elif not getattr(stream, "problem", None):
                yield headers, None, "body cut off"
        line = stream.readline()


def _pass_over(stream, count: int) -> None:
    if hasattr(stream, "skip"):
        stream.skip(count)
    else:
        stream.read(count)


def archive_batches(file_id: str, path: str) -> Iterator[pa.RecordBatch]:
    rows, size = [], 0
    with open_stream(path) as raw:
        for number, (headers, body, problem) in enumerate(iter_records(Members(raw))):
            rows.append((file_id, number, list(headers.items()) if headers is not None else None, body, problem))
            size += len(body or b"")
            if size >= BATCH_BYTES or len(rows) >= BATCH_ROWS:
                yield _as_batch(rows)
                rows, size = [], 0
    if rows:
        yield _as_batch(rows)


def _as_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(values, field.type) for values, field in zip(columns, _ARROW_SCHEMA)], schema=_ARROW_SCHEMA
    )


def archive_paths(spark: SparkSession, path: str, glob: str = "*.gz") -> DataFrame:
    """``(file_id, path, length)`` of the archives under a folder; no content is read.

    The path is the id: archive numbers repeat between parts of a crawl.
    """
    found = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", "true")
        .load(path)
    )
    return found.select(F.col("path").alias("file_id"), "path", "length")


UNREADABLE = "unreadable archive: "


def scan_archives(
    archives: DataFrame, mode: str = "PERMISSIVE", tasks: int | None = None, report_unreadable: bool = False
) -> DataFrame:
    """Records of the archives named by ``(file_id, path)`` rows.

    ``tasks`` spreads the file list, as one file is one unit of work; by default
    there is a task for each file. A file that cannot be opened or read on fails the job,
    so that it is never taken for done; with ``report_unreadable`` it gives one damaged record that says so instead.
    """

    def scan(batches):
        for batch in batches:
            for row in batch.to_pylist():
                found = archive_batches(row["file_id"], row["path"])
                while True:
                    try:
                        batch = next(found)
                    except StopIteration:
                        break
                    except OSError as error:
                        if not report_unreadable:
                            raise
                        batch, found = _as_batch([(row["file_id"], None, None, None, f"{UNREADABLE}{error}")]), iter(())
                    yield batch

    named = archives.select("file_id", "path")
    number = (F.row_number().over(W.orderBy("path", "file_id")) - 1).cast("int")
    count = tasks or max(1, named.count())
    spread = named.withColumn("task", number).repartitionById(count, "task").drop("task")
    return apply_mode(spread.mapInArrow(scan, RECORD_SCHEMA), mode)


def apply_mode(records: DataFrame, mode: str) -> DataFrame:
    """PERMISSIVE keeps damaged records with the reason, DROPMALFORMED leaves them out."""
    if mode == "PERMISSIVE":
        return records
    if mode == "DROPMALFORMED":
        return records.filter(F.col("_corrupt_record").isNull())
    raise ValueError(f"unknown mode {mode!r}")


def read_warc(spark: SparkSession, path: str, mode: str = "DROPMALFORMED") -> DataFrame:
    return scan_archives(archive_paths(spark, path), mode)


def record_fields(records: DataFrame, *others: str) -> DataFrame:
    """Named header fields next to the body and other columns; a missing target URI is empty text."""

    def header(name: str):
        return F.try_element_at("headers", F.lit(name))

    return records.select(
        "file_id",
        "record_no",
        header("warc-type").alias("warc_type"),
        F.coalesce(header("warc-target-uri"), F.lit("")).alias("target_uri"),
        header("warc-date").alias("warc_date"),
        header("warc-identified-payload-type").alias("payload_type"),
        header("content-length").try_cast("long").alias("content_length"),
        "body",
        *others,
    )


class _ArchivePartition(InputPartition):
    def __init__(self, path: str):
        super().__init__(path)
        self.path = path


class _WarcReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]

    def partitions(self):
        scheme, name = split_path(self.path)
        system, root = fs.FileSystem.from_uri(name) if scheme else (fs.LocalFileSystem(), name)
        # Arrow's paths leave out the scheme, and the host except of object stores
        host = name.split("://")[1].split("/")[0] if scheme else ""
        prefix = "" if not scheme else f"{scheme}://" if root.startswith(host) else f"{scheme}://{host}"
        info = system.get_file_info(root)
        files = [info] if info.is_file else system.get_file_info(fs.FileSelector(root, recursive=True))
        return [_ArchivePartition(prefix + f.path) for f in files if f.is_file and f.path.endswith(".gz")]

    def read(self, partition):
        yield from archive_batches(partition.path, partition.path)


class WarcDataSource(DataSource):
    """``spark.read.format("warc").load(path)``: one partition per archive."""

    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return RECORD_SCHEMA

    def reader(self, schema):
        return _WarcReader(self.options)


def register_warc_source(spark: SparkSession) -> None:
    spark.dataSource.register(WarcDataSource)
