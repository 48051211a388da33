"""Page parsing, one probe per rule."""

import time
import tracemalloc

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from webloom.functions.html import PageScan, page_udf
from webloom.functions.markup import hrefs_of, page_tags, title_of
from webloom.functions.urls import page_links
from webloom.plans.pages import page_parts

HEAD = "<!DOCTYPE html><html><head>"


@pytest.mark.parametrize(
    "html, text",
    [
        ("<html><body>a<script>x<p></script>b<style>p{}</style>c", "abc"),
        ("<html>a<br>b<p>c</p>d<div>e</div>f<ul><li>g<li>h</ul>i", "a\nbc\nde\nfg\nh\ni"),
        ("<html><title>T</title><h1>H</h1><td>x</td><td>y", "THxy"),  # only four elements break lines
        ("<html>a<!-- <p>no</p> -->b<!---->c<!>d", "abcd"),
        ("<html><p><b>one<br><p>two</p>", "one\n\ntwo"),  # the second p ends the first
        ("<html>a</p>b", "a\nb"),  # an end tag alone makes an empty paragraph
        ("<html>a</br>b", "a\nb"),
        ("<html>a &amp; b&nbsp;c &copy; &lt;p&gt; &am", "a & b\xa0c © <p> &am"),
        ("<html>1 < 2 <3", "1 < 2 <3"),
        ("<html><a title='x>y' href=z>t</a>", "t"),
        ('<html>a<a href="x', "a"),  # tag cut off by the end of the page
        ("<html>a<template><p>no</p></template>b", "ab"),
        ("<html>a<noscript><p>raw</p></noscript>b", "a<p>raw</p>b"),
        ("<html><textarea>&lt;b><i></textarea>z", "<b><i>z"),
        ("<html><table><tr><td><p>a<td>b</table>c", "a\nbc"),
        ("<html><div>a<span>b</div>c", "ab\nc"),
        ("<html><b><p>a</b>b</p>c", "ab\nc"),
        ("<html>  a \xa0", "a"),
        ("<html></body></html>late", "late"),
        ("<html><button><p>a</button>b", "a\nb"),
        ("<html><P>a</P>b<BR/>c", "a\nb\nc"),
        ("<html><p>a<table>b</table></p>c", "ab\nc"),  # no doctype: the table stays in the paragraph
        (HEAD + "<p>a<table>b</table>c", "a\nbc"),
        ("<html>a<![CDATA[x]]>b<?php x ?>c", "abc"),
        ("<html><select><option>a<p>b</p><div>c<option>d</select>e", "abcde"),
        ("<html><p>a<plaintext>b<p>&amp;", "a\nb<p>&amp;"),
        ("<html>", ""),
    ],
)
def test_visible_text(html, text):
    assert PageScan(html).text == text


TITLES = [
        ("<html><title>A &amp; B</title><title>C</title>", "A & B"),
        ("<html><title></title><title>second</title>", "second"),
        ("<html><title> kept </title>", " kept "),
        ("<html><svg><title>inner</title></svg>", "inner"),
        ("<html><meta name=description content=d><p>x", None),
        ("<html><title>a<b>c</title>", "a<b>c"),
        ("<html><template><title>no</title></template>", None),
        ("<html><title>open", "open"),
    ]

LINKS = [
        ("", "http://h.org/a/b?q=1"),
        ("#f", "http://h.org/a/b?q=1#f"),
        ("?x=y z", "http://h.org/a/b?x=y%20z"),
        ("c/../../d", "http://h.org/d"),
        ("..", "http://h.org/"),
        (".", "http://h.org/a/"),
        ("/für", "http://h.org/f%C3%BCr"),
        ("/a b?c='d'", "http://h.org/a%20b?c=%27d%27"),
        ("//Other.ORG:80/x", "http://other.org/x"),
        ("HTTPS://h.org:443", "https://h.org/"),
        ("https:x", "https://x/"),
        ("http:y", "http://h.org/a/y"),
        ("\\e\\f", "http://h.org/e/f"),
        ("mailto:me@x.org", "mailto:me@x.org"),
        ("javascript:void(0)", "javascript:void(0)"),
        ("http://bücher.de/", "http://xn--bcher-kva.de/"),
        ("http://a b/", "http://a b/"),  # cannot be resolved: stays as typed
        ("http://h:99999/", "http://h:99999/"),
        (" \tx\n y ", "http://h.org/a/x%20y"),
        ("/%7e%zz", "http://h.org/%7e%zz"),
        ("/a/./b//c/%2E%2e/d", "http://h.org/a/b//d"),
        ("http://u:p@h.org/", "http://u:p@h.org/"),
        ("x#a b`", "http://h.org/a/x#a%20b%60"),
    ]


def test_titles(spark):
    more = [
        ("<html><!-- <title>no</title> --><script>'<title>no</title>'</script><title>yes</title>", "yes"),
        ("<html><a title='<title>no</title>'><TITLE lang=x>Yes</TITLE >", "Yes"),
        ("<html><template><template></template><title>no</title></template><title>&#65;&#x42;&eacute&notit;&#128;&#0;</title>", "ABé¬it;€\ufffd"),
        ("<html><select><title>no</title></select><title>a\0b\rc</title>", "ab\nc"), (None, None), ("<html><title/>x", "x"),
    ]
    pages = spark.createDataFrame([(n, h, t) for n, (h, t) in enumerate([*TITLES, *more])], "n int, html string, title string")
    found = pages.withColumn("found", title_of(page_tags(F.col("html")))).collect()
    assert [(r.html, r.found) for r in found] == [(r.html, r.title) for r in found]


def test_link_resolution(spark):
    links = spark.createDataFrame([(h, x) for h, x in LINKS], "href string, link string")
    found = links.withColumn("found", page_links(F.lit("http://h.org/a/b?q=1#top"), F.array("href"))).collect()
    assert [(r.href, r.found) for r in found] == [(r.href, [r.link]) for r in found]


def links_of(spark, html, url):
    page = spark.createDataFrame([(html, url)], "html string, url string")
    return page.select(page_links(F.col("url"), hrefs_of(page_tags(F.col("html"))))).first()[0]


def test_links_keep_order_and_repeats(spark):
    html = '<html><a href=/1>x</a><A HREF="/2?a=1&amp;b=2">y</a><a name=n><a href=/1><svg><a xlink:href=/3></svg><a xlink:href=/4>'
    assert links_of(spark, html, "https://h.org/") == ["https://h.org/1", "https://h.org/2?a=1&b=2", "https://h.org/1", "https://h.org/3"]
    hidden = "<html><!--<a href=/1>--><template><a href=/2></template><textarea><a href=/3></textarea><select><a href=/4></select><b title='<a href=/5>'>"
    assert links_of(spark, hidden, "https://h.org/") is None
    assert links_of(spark, "<html><a title='x>y' href=z>t</a><a href='", "https://h.org/") == ["https://h.org/z"]


@pytest.mark.parametrize("url", ["", "dns:h.org", "not a url", "http:///", None])
def test_no_links_without_a_base(spark, url):
    assert links_of(spark, "<html><a href=/1>", url) is None


def test_attribute_references(spark):
    page = spark.createDataFrame([('<html><a href="/?a&copy=1&copy2&copy;&ampx&#65;&amp">',)], "html string")
    assert page.select(hrefs_of(page_tags(F.col("html")))).first()[0] == ["/?a&copy=1&copy2©&ampxA&"]


HOSTILE = [
    "<html>" + "<div><span>" * 100_000, "<html>" + "<p " * 100_000, "<html>" + "<!-- " * 100_000, "<html>" + "<" * 300_000,
    "<html><p " + "a='b' " * 100_000 + "><title>t</title>", "<html>" + "<template>" * 20_000, "<html><title>" + "&amp" * 20_000,
]


@pytest.mark.parametrize("html", HOSTILE[:5])
def test_hostile_pages_stay_linear(html):
    start = time.time()
    PageScan(html)
    assert time.time() - start < 10


def test_parts_of_hostile_pages_stay_linear(spark):
    pages = spark.createDataFrame([(h,) for h in HOSTILE], "html string").repartition(4)
    start = time.time()
    titles = {r[0] for r in pages.select(title_of(page_tags(F.col("html")))).collect()}
    assert time.time() - start < 60 and titles == {None, "t", "&" * 20_000}


def test_no_python_for_titles_and_links(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    plan = page_parts(pages)._jdf.queryExecution().executedPlan().toString()
    assert "EvalPython" not in plan and "InArrow" not in plan


def test_a_large_batch_of_pages_is_not_held_as_python_objects(spark):
    pages = [f"<html><title>{n}</title><p>some <b>bold</b> text &amp; more" * 20 for n in range(1500)] + ["", None, "<p>"]
    parse = page_udf().func
    tracemalloc.start()
    found = parse(pa.array(pages, pa.string()))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 1 << 20
    assert found.to_pylist() == [{"text": PageScan(p).text or None, "lang": None} if p else None for p in pages]
    assert len(parse(pa.array([], pa.string()))) == 0
