"""Text files read as ordered lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(line, line_pos)`` of a file or folder of text files.

    Ends of line are LF or CRLF; a lone CR stays. ``line_pos`` sorts as the file
    does: file, byte offset of the split, row within the split. Nothing forces
    the file into one task, so a list of any length can be read.
    """
    text = spark.read.option("lineSep", "\n").text(path)
    return text.select(
        F.regexp_replace("value", r"\r\z", "").alias("line"),
        F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("offset"),
            F.monotonically_increasing_id().alias("row"),
        ).alias("line_pos"),
    )


def first_lines(lines: DataFrame, count: int) -> DataFrame:
    """The first ``count`` lines in file order; 0 means all of them."""
    return lines.orderBy("line_pos").limit(count) if count else lines


def file_number(path: Column) -> Column:
    """Text after the last ``-`` of an archive's path, up to its first ``.``."""
    return F.split_part(F.substring_index(path, "-", -1), F.lit("."), F.lit(1))
