"""Column expressions: hosts, tokens, response parts."""

import pytest
from pyspark.sql import functions as F

from webloom import html_responses, tokens, truncate_word, url_host
from webloom.functions.http import content_type, decoded_body, response_parts, status_code
from webloom.functions.text import word_count


def column(spark, values, expression, kind="string"):
    rows = spark.createDataFrame([(n, v) for n, v in enumerate(values)], f"n int, v {kind}")
    return [r[0] for r in rows.select("n", expression(F.col("v")).alias("x")).orderBy("n").select("x").collect()]


HOSTS = {
    "http://Ex.COM/a": "ex.com",
    "https://www.ex.com": "www.ex.com",
    "http://User:p%40@ex.com:80/a": "ex.com",
    "http://a@b@ex.com/": "ex.com",
    "https://[::1]:8080/x": "[::1]",
    "http://a_b.com/x y": "a_b.com",
    "http:\\\\x.org\\a": "x.org",
    "http:x.org": "x.org",
    "  https://t.co#f\n": "t.co",
    "http://h.org?x@y": "h.org",
    "http://h.org:/x": "h.org",
    "http://bücher.de/": "xn--bcher-kva.de",
    "http://ex%41mple.com/": "example.com",
    "ftp://f.org/": "f.org",
    "file:///etc/passwd": None,
    "http://a b.com/": None,
    "http://h:99999/": None,
    "http://h:8a/": None,
    "http://": None,
    "dns:example.com": None,
    "urn:isbn:1": None,
    "mailto:a@b.org": None,
    "relative/path": None,
    "": None,
    None: None,
}


def test_url_host(spark):
    assert dict(zip(HOSTS, column(spark, list(HOSTS), url_host))) == HOSTS


def test_host_of_plain_urls_needs_no_python_worker(spark):
    plan = spark.range(1).select(url_host(F.lit("http://x.org/"))).groupBy().count()
    text = spark.createDataFrame([("http://x.org/",)], "u string").select(url_host(F.col("u")))
    assert "Python" not in text._jdf.queryExecution().executedPlan().toString().replace("PythonRDD", "")
    assert plan.first()[0] == 1


def test_tokens(spark):
    probes = {
        "Don't X-Y f\u00fcr 3.14": ["dont", "xy", "fr", "314"],
        "no\u00a0break\u2003wide\u3000x\u200by": ["no", "break", "wide", "xy"],  # U+200B is not a blank
        "\u0130stanbul 0\u212a": ["istanbul", "0k"],  # dotted capital I, Kelvin sign
        " \t": [],
        "!!": [],
        "Words words": ["words", "words"],
    }
    assert dict(zip(probes, column(spark, list(probes), tokens))) == probes
    assert column(spark, [None], tokens) == [None]


def test_truncation_and_word_count(spark):
    words = ["x" * 39, "x" * 40, "x" * 41, "x" * 80, "é" * 41]
    assert column(spark, words, truncate_word) == ["x" * 39, "x" * 40, "x" * 40, "x" * 40, "é" * 40]
    assert column(spark, ["a b a", "", None], lambda c: word_count(tokens(c))) == [3, 0, 0]


@pytest.mark.parametrize("line, kind", [
    ("Content-Type: text/html; charset=x", "text/html; charset=x"),
    ("Content-Type:text/html : y", "text/html"),
    ("Content-Type:\ttext/html\r", "text/html"),
    ("Content-Type-Options: nosniff", "nosniff"),
    ("Content-Type", None),
])
def test_content_type(spark, line, kind):
    assert column(spark, [line], content_type) == [kind]


def test_status_code(spark):
    probes = {
        "HTTP/1.1 404 Not Found": 404, "HTTP/1.1\t200": 200, "HTTP/1.1 abc": None, "HTTP/1.1": None,
        "HTTP 12.5": None, "HTTP -5": None, "HTTP 99999999999": None,
    }
    assert dict(zip(probes, column(spark, list(probes), status_code))) == probes


OK = "HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n"
BODIES = {
    "plain": (OK + "<html>a\nb</html>", "<html>ab</html>"),
    "crlf, lone cr kept": (OK + "<html>a\r\nb\rc", "<html>ab\rc"),
    "text before the page": (OK + "junk\n<!DOCTYPE html><html>x", "<!DOCTYPE html><html>x"),
    "status kept whatever it is": (OK.replace("200", "404") + "<html>x", "<html>x"),
    "header-like lines in the page are lost": (OK + "<html>a\nHTTP is nice\nb", "<html>ab"),
    "upper case tag": (OK + "<HTML>x", None),
    "header only after the page": ("<html>x\n" + OK, None),
    "page line that is a header": (OK + "HTTP <html>\nx", None),
    "page starts once": (OK + "<html>a\n<html>b", "<html>a<html>b"),
    "no end of line at the end": (OK + "<html>", "<html>"),
}


def records(spark, bodies):
    rows = [(n, b if isinstance(b, bytes) else b.encode()) for n, b in enumerate(bodies)]
    return spark.createDataFrame(rows, "record_no int, body binary")


def test_html_body(spark):
    found = {r.record_no: r.html_body for r in html_responses(records(spark, [b for b, _ in BODIES.values()])).collect()}
    assert {n: found.get(at) for at, n in enumerate(BODIES)} == {n: h for n, (_, h) in BODIES.items()}


def test_records_dropped_before_parsing(spark):
    kept = html_responses(records(spark, [
        OK + "<html>",
        b"HTTP/1.1 200\nContent-Type: text/html\n\n<html>\xff",  # not UTF-8
        OK.replace("text/html", "application/json") + "<html>",
        OK.replace("Content-Type", "content-type") + "<html>",  # case matters
        OK.replace("text/html", "TEXT/HTML") + "<html>",
        OK + "<html>\nContent-Type: image/png\n",  # a later line rejects the record
        OK + "<html>\nContent-Type of nothing\n",
        "HTTP/1.1 200\n\n<html>",
        OK.replace("text/html", "x : text/html") + "<html>",  # named in the third field only
    ])).filter("html_body IS NOT NULL").select("record_no")
    assert [r.record_no for r in kept.collect()] == [0]


def test_last_header_line_counts(spark):
    body = OK + "<html>\nHTTP/1.1 500\nContent-Type: text/html; v=2\n"
    row = response_parts(decoded_body(records(spark, [body]))).first()
    assert (row.status_code, row.content_type) == (500, "text/html; v=2")


def test_long_bodies(spark):
    page = "<html>" + "x" * 3_000_000 + "\n" + "y\n" * 500_000
    row = html_responses(records(spark, [OK + page])).select(F.length("html_body").alias("n")).first()
    assert row.n == 6 + 3_000_000 + 500_000
