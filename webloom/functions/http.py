"""HTTP responses as stored in crawl records, taken apart with built-in functions.

Header tests look at every line of the body, also past the blank line, and mind
case. The body is split into lines once; what follows are short tests per line,
which is several times faster than patterns run over whole bodies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webloom.functions.text import UNICODE_BLANKS


def _is_type(line: Column) -> Column:
    return line.startswith("Content-Type")


def _is_status(line: Column) -> Column:
    return line.startswith("HTTP")


def _is_header(line: Column) -> Column:
    return _is_type(line) | _is_status(line)


def _position(lines: str, condition) -> Column:
    """1-based position of the first line that meets a condition, 0 if none."""
    return F.array_position(F.transform(lines, condition), True).cast("int")


def _from(lines: str, position: str) -> Column:
    """Lines from a position on; none for position 0."""
    return F.when(F.col(position) > 0, F.slice(lines, F.greatest(F.col(position), F.lit(1)), F.size(lines))).otherwise(
        F.array().cast("array<string>")
    )


def content_type(line: Column) -> Column:
    """Second ``:`` field of a header line; text after a second ``:`` is not kept."""
    return F.trim(F.get(F.split(line, ":"), F.lit(1)), F.lit(UNICODE_BLANKS))


def status_code(line: Column) -> Column:
    """Second blank-separated field as an integer, NULL when it is not one."""
    field = F.regexp_extract(line, r"(?U)^\s*\S+\s+\+?([0-9]+)(?:\s|$)", 1)
    return field.try_cast("int")


def _names_html(line: Column) -> Column:
    return F.coalesce(content_type(line).contains("text/html"), F.lit(False))


def decoded_body(records: DataFrame) -> DataFrame:
    """Keep the records whose body is valid UTF-8, with it as ``body_text``."""
    text = F.col("body").cast("string")
    return records.filter(F.is_valid_utf8(text)).withColumn("body_text", text)


def response_parts(decoded: DataFrame) -> DataFrame:
    """Add ``content_type``, ``status_code`` and ``html_body``.

    The last type line and the last status line give the fields. ``html_body``
    is every other line from the first ``<html`` after a header on, joined
    without line ends. It is NULL when there is no such line, no type line, or a
    type line that is not HTML.
    """
    columns = [name for name in decoded.columns if name not in ("body", "body_text")]
    body = F.replace(F.col("body_text"), F.lit("\r\n"), F.lit("\n"))
    lines = decoded.select(*columns, F.split(body, "\n").alias("_lines"))
    typed = lines.select(
        *columns,
        F.filter("_lines", _is_type).alias("_types"),
        F.filter("_lines", _is_status).alias("_statuses"),
        "_lines",
        _position("_lines", _is_header).alias("_header_at"),
    )
    other = typed.withColumn("_rest", F.filter(_from("_lines", "_header_at"), lambda line: ~_is_header(line)))
    placed = other.withColumn("_page_at", _position("_rest", lambda line: line.contains("<html")))
    is_html = (F.size("_types") > 0) & F.forall("_types", _names_html) & (F.col("_page_at") > 0)
    return placed.select(
        *columns,
        content_type(F.try_element_at("_types", F.lit(-1))).alias("content_type"),
        status_code(F.try_element_at("_statuses", F.lit(-1))).alias("status_code"),
        F.when(is_html, F.array_join(_from("_rest", "_page_at"), "")).alias("html_body"),
    )


def html_responses(records: DataFrame) -> DataFrame:
    """Records that can hold an HTML page; ``html_body`` is NULL if one does not.

    The tests in front are necessary ones that cost next to nothing. The exact
    answer is left in ``html_body``: as a filter it would be pushed below the
    extraction and have all of it run twice.
    """
    decoded = decoded_body(records)
    body = F.col("body_text")
    return response_parts(
        decoded.filter(body.contains("Content-Type") & body.contains("text/html") & body.contains("<html"))
    )
