"""The package's operators applied to the provided tables, one function per query.

Inputs the tables do not hold (archives, a site list, a lemma file) are derived
from them by Spark, whole, and stored once per session in the shared folder.
"""

from __future__ import annotations

import hashlib
import uuid
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from webloom.functions.http import decoded_body, html_responses, response_parts
from webloom.functions.text import tokens, truncate_word, word_count
from webloom.functions.urls import url_host
from webloom.operators.audit import audit_fk, audit_not_null, audit_unique
from webloom.operators.hosts import filter_hosts, site_allowlist
from webloom.operators.language import (
    LanguageModel, detect_language, language_weights, load_language_model, trigram_counts,
)
from webloom.operators.ledger import mark_processed, pending_files, seed_ledger
from webloom.operators.lemmas import lemma_dictionary, lemmatise
from webloom.operators.ids import StableIds
from webloom.operators.merge import (
    accumulate, dense_ids, insert_if_absent, postings_by_id, postings_by_key, replace_children,
)
from webloom.plans.counters import scan_counters
from webloom.plans.index import (
    Index, build_index, document_frequency, latest_pages, link_rows, mark_latest, merge_index,
    recompute_keywords, term_counts, term_frequency, website_rows,
)
from webloom.plans.pages import indexable, page_parts, page_text, parse_pages
from webloom.plans.store import IndexStore
from webloom.session import Lookup, checked_lookup, scratch_dir, spread
from webloom.sources.lines import file_number, first_lines, read_lines
from webloom.sources.pages import pages_as_records
from webloom.sources.warc import archive_paths, read_warc, record_fields, register_warc_source, scan_archives
from webloom.streaming.ingest import ingest_pending, ingest_stream

IDS_BROADCAST = 1_000_000
SITE_PREFIX = 100  # lines; only of the queries whose feature is a prefix of the list
PAGES_PER_ARCHIVE = 64
_stored: set[str] = set()


def archive_of(page_id: Column) -> Column:
    """Archive a page belongs to: archives hold so many pages, and a larger table has more of them."""
    return F.lpad(F.floor(page_id / PAGES_PER_ARCHIVE).cast("string"), 9, "0")


def archive_in(path: Column) -> Column:
    return F.regexp_extract(path, r"file_id=([^/]+)", 1)


def url_language(url: Column) -> Column:
    return F.regexp_extract(url, r"^https?://[^/]+/([a-z]+)/", 1)


class Inputs:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self.scratch = f"{scratch_dir(spark)}/{hashlib.md5(self.sf_dir.encode()).hexdigest()}"

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def stored(self, name: str, write) -> str:
        """Path of a derived input, written on first use in this session."""
        path = f"{self.scratch}/{name}"
        if path not in _stored:
            write(path)
            _stored.add(path)
        return path

    # --- derived inputs -------------------------------------------------------

    def records(self) -> DataFrame:
        return pages_as_records(spread(self.table("pages")), archive_of(F.col("page_id")))

    def documents(self) -> DataFrame:
        return spread(self.table("documents").select("doc_id", "text", "lang"))

    def varied_records(self) -> DataFrame:
        """Response heads that differ by the language in the URL."""
        language = url_language(F.col("url"))
        head = (
            F.when(language == "de", "HTTP/1.1 404 Not Found\r\nContent-Type: text/html : late\r\n\r\n")
            .when(language == "es", "HTTP/1.1 none\r\nContent-Type: application/json\r\n\r\n")
            .when(language == "fr", "HTTP/1.1 301\r\ncontent-type: text/html\r\n\r\n")
            .otherwise("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n")
        )
        return spread(self.table("pages")).select(
            F.col("page_id").alias("record_no"),
            F.col("url").alias("target_uri"),
            F.concat(head, "html").cast("binary").alias("body"),
        )

    def url_lines(self) -> DataFrame:
        lines = self.table("pages").orderBy("page_id").select("url")
        return read_lines(self.spark, self.stored("urls", lambda path: lines.write.mode("overwrite").text(path)))

    def site_list(self) -> DataFrame:
        hosts = self.table("pages").orderBy("page_id").select(url_host(F.col("url")).alias("host"))
        return read_lines(self.spark, self.stored("sites", lambda path: hosts.write.mode("overwrite").text(path)))

    def allowlist(self, lines: int = 0) -> DataFrame:
        """Hosts of the whole site list, or of its first ``lines``."""
        return site_allowlist(self.site_list(), lines)

    def lemma_lines(self) -> DataFrame:
        """A line per word of the conversations; those with a digit are malformed."""
        words = self.table("conversations").select(F.explode(tokens(F.col("text"))).alias("w")).distinct()
        stem = F.concat(F.substring("w", 1, 4), F.lit("/"), F.length("w"))
        line = F.when(F.col("w").rlike("[0-9]"), F.concat(stem, F.lit("- -> "), "w")).otherwise(
            F.concat(stem, F.lit(" -> "), "w", F.lit(", "), "w", F.lit("s"))
        )
        lines = words.orderBy("w").select(line.alias("line"))
        return read_lines(self.spark, self.stored("lemmas", lambda path: lines.write.mode("overwrite").text(path)))

    def dictionary(self) -> DataFrame:
        path = self.stored(
            "dictionary", lambda path: lemma_dictionary(self.lemma_lines()).write.mode("overwrite").parquet(path)
        )
        return self.spark.read.parquet(path)

    @cached_property
    def model(self) -> LanguageModel:
        weights = language_weights(trigram_counts(self.documents()))
        path = self.stored("language", lambda path: weights.write.mode("overwrite").parquet(path))
        return load_language_model(self.spark.read.parquet(path))

    def archives(self, damaged: bool = False) -> str:
        """Folder of gzip archives with one record per page.

        In the damaged set, records of pages that are cut off have no usable
        length and pages of one host have no target URI.
        """
        body = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"), "html")
        uri = F.concat(F.lit("WARC-Target-URI: "), "url", F.lit("\r\n"))
        length = F.octet_length(body).cast("string")
        if damaged:
            length = F.when(F.col("html").contains("</html>"), length).otherwise("unknown")
            uri = F.when(F.col("url").contains("spam-farm"), "").otherwise(uri)
        record = F.concat(
            F.lit("WARC/1.0\r\nWARC-Type: response\r\n"),
            uri,
            F.lit("WARC-Date: 2024-04-12T10:13:54Z\r\nWARC-Identified-Payload-Type: text/html\r\nContent-Length: "),
            length,
            F.lit("\r\n\r\n"),
            body,
        )
        rows = self.table("pages").select(archive_of(F.col("page_id")).alias("file_id"), record.alias("value"))
        return self.stored(
            "damaged_archives" if damaged else "archives",
            lambda path: rows.repartition("file_id")
            .write.mode("overwrite").partitionBy("file_id")
            .option("compression", "gzip").option("lineSep", "\r\n\r\n").text(path),
        )

    def parsed(self) -> DataFrame:
        """English pages of listed hosts with tokens and links, parsed once and stored.

        Every index query reads this table, as an index run does; ``parse_pages``
        and ``incremental_ingest`` run the parser themselves.
        """
        def write(path: str) -> None:
            pages = parse_pages(filter_hosts(self.records(), self.allowlist()), self.model)
            pages.drop("html_body", "text_body").write.mode("overwrite").parquet(path)

        return self.spark.read.parquet(self.stored("parsed", write))

    def marked(self) -> DataFrame:
        return mark_latest(indexable(self.parsed()))

    def terms(self) -> DataFrame:
        return term_counts(self.marked(), self.dictionary())

    def keywords(self) -> DataFrame:
        return accumulate(document_frequency(self.terms()).drop("file_id"), ["word"], "documents_containing_word")

    def site_pages(self, scheme: str) -> DataFrame:
        """Pages of one crawl keyed by host, so that keys repeat within and between crawls."""
        pages = self.parsed().filter(F.col("url").startswith(scheme + "://"))
        return pages.withColumn("url", url_host(F.col("url")))

    def site_indexes(self) -> tuple[Index, Index]:
        """The plain-http crawl as stored index, the https crawl as new batch."""
        dictionary = self.dictionary()
        return build_index(self.site_pages("http"), dictionary), build_index(self.site_pages("https"), dictionary)

    def ledger_names(self) -> DataFrame:
        prefix = F.substring(F.md5(F.col("url").cast("binary")), 1, 2)
        name = F.concat(F.lit("crawl-data/"), prefix, F.lit("/warc/part-"), prefix, F.lit(".warc.gz"))
        return self.table("pages").select(name.alias("file_name"), "url")

    def ledger(self) -> DataFrame:
        """Ledger in which names that begin with a zero have no flag yet."""
        unknown = F.col("file_name").startswith("crawl-data/0")
        return seed_ledger(self.ledger_names()).withColumn(
            "processed", F.when(~unknown, F.col("processed"))
        )

    def marked_ledger(self) -> DataFrame:
        return mark_processed(self.ledger(), self.ledger_names().filter(F.col("url").startswith("https:")))


# --- sources ----------------------------------------------------------------------


def line_prefix(i: Inputs) -> DataFrame:
    return first_lines(i.url_lines(), SITE_PREFIX).select("line")


def allowlist_hosts(i: Inputs) -> DataFrame:
    return i.allowlist(SITE_PREFIX)


def lemma_dictionary_job(i: Inputs) -> DataFrame:
    return lemma_dictionary(i.lemma_lines())


def warc_scan(i: Inputs) -> DataFrame:
    return record_fields(read_warc(i.spark, i.archives())).select(
        archive_in(F.col("file_id")).alias("file_id"),
        "target_uri",
        "content_length",
        F.md5("body").alias("body_md5"),
    )


def warc_data_source(i: Inputs) -> DataFrame:
    register_warc_source(i.spark)
    return record_fields(i.spark.read.format("warc").load(i.archives())).select(
        archive_in(F.col("file_id")).alias("file_id"), "target_uri", F.md5("body").alias("body_md5")
    )


def warc_corrupt_rows(i: Inputs) -> DataFrame:
    records = scan_archives(archive_paths(i.spark, i.archives(damaged=True)))
    return records.groupBy(archive_in(F.col("file_id")).alias("file_id")).agg(
        F.count_if(F.col("_corrupt_record").isNull()).alias("good"),
        F.count("_corrupt_record").alias("damaged"),
    )


def record_headers(i: Inputs) -> DataFrame:
    records = record_fields(read_warc(i.spark, i.archives(damaged=True)))
    return records.select(
        "warc_type", "target_uri", "warc_date", "payload_type", "content_length", F.md5("body").alias("body_md5")
    )


def file_number_job(i: Inputs) -> DataFrame:
    path = F.concat(
        F.lit("crawl-data/"), archive_of(F.col("page_id")), F.lit("/warc/CC-MAIN-2024-"),
        F.lpad(F.col("page_id").cast("string"), 8, "0"), F.lit(".warc.gz"),
    )
    return i.table("pages").select(path.alias("path"), file_number(path).alias("file_number"))


def ledger_pending(i: Inputs) -> DataFrame:
    return pending_files(i.marked_ledger())


# --- projections and filters --------------------------------------------------------


def url_host_job(i: Inputs) -> DataFrame:
    host = url_host(F.col("url"))
    variant = F.concat(F.lit(" HTTP://user:pass@"), F.upper(host), F.lit(":8080\\x?y"))
    named = i.table("pages").select("page_id", host.alias("host"), variant.alias("variant"))
    return named.select("page_id", "host", url_host(F.col("variant")).alias("variant_host"))


def utf8_valid(i: Inputs) -> DataFrame:
    french = url_language(F.col("target_uri")) == "fr"
    broken = i.varied_records().withColumn(
        "body", F.when(french, F.concat(F.unhex(F.lit("C328")), "body")).otherwise(F.col("body"))
    )
    return decoded_body(broken).select("record_no")


def content_type_job(i: Inputs) -> DataFrame:
    return response_parts(decoded_body(i.varied_records())).select("record_no", "content_type")


def status_code_job(i: Inputs) -> DataFrame:
    return response_parts(decoded_body(i.varied_records())).select(
        "record_no", F.col("status_code").cast("string").alias("status_code")
    )


def filter_html(i: Inputs) -> DataFrame:
    return html_responses(i.varied_records()).filter(F.col("html_body").isNotNull()).select("record_no", "content_type")


def html_body(i: Inputs) -> DataFrame:
    return html_responses(i.records()).select("record_no", "html_body").filter(F.col("html_body").isNotNull())


def _pages(i: Inputs) -> DataFrame:
    """HTML of the whole pages table, as responses come from archives."""
    return html_responses(i.records()).withColumnsRenamed({"record_no": "page_id", "target_uri": "url"})


def page_title(i: Inputs) -> DataFrame:
    return page_parts(_pages(i), html="html_body").select("page_id", "title")


def page_description(i: Inputs) -> DataFrame:
    return page_parts(_pages(i), html="html_body").select("page_id", "description")


def visible_text_tokens(i: Inputs) -> DataFrame:
    return page_text(_pages(i), html="html_body").select("page_id", F.posexplode(tokens(F.col("text_body"))).alias("pos", "token"))


def page_links(i: Inputs) -> DataFrame:
    return page_parts(_pages(i), html="html_body").select("page_id", F.posexplode("links").alias("pos", "link"))


def detect_language_job(i: Inputs) -> DataFrame:
    return i.documents().select("doc_id", detect_language(F.col("text"), i.model).alias("detected"))


def language_weights_job(i: Inputs) -> DataFrame:
    return language_weights(trigram_counts(i.documents()))


def tokens_job(i: Inputs) -> DataFrame:
    return i.documents().select("doc_id", F.posexplode(tokens(F.col("text"))).alias("pos", "token"))


def lemmatised_tokens(i: Inputs) -> DataFrame:
    words = i.documents().select("doc_id", tokens(F.col("text")).alias("words"))
    return lemmatise(words, "words", i.dictionary(), ["doc_id"])


def keyword_truncate(i: Inputs) -> DataFrame:
    words = i.documents().select(F.explode(tokens(F.col("text"))).alias("word")).distinct()
    return words.select(
        "word", truncate_word(F.col("word")).alias("keyword"), truncate_word(F.col("word"), 8).alias("keyword_8")
    )


def word_count_job(i: Inputs) -> DataFrame:
    return i.documents().select("doc_id", word_count(tokens(F.col("text"))).alias("word_count"))


def parse_pages_job(i: Inputs) -> DataFrame:
    return parse_pages(i.records(), i.model).select(
        "file_id", "record_no", "url", "warc_identified_payload_type", "status_code", "content_type",
        "content_length", "title", "description", "lang",
        F.coalesce(F.size("links"), F.lit(0)).alias("link_count"),
        word_count(F.col("tokens")).alias("word_count"),
    )


def filter_english(i: Inputs) -> DataFrame:
    return page_text(_pages(i), i.model, "html_body").filter(F.col("lang") == "en").select("page_id", "lang")


def indexable_pages(i: Inputs) -> DataFrame:
    return indexable(i.parsed()).select("record_no", "url", "title")


# --- joins and aggregations -----------------------------------------------------------


def allowlist_semi_join(i: Inputs) -> DataFrame:
    return filter_hosts(i.records(), i.allowlist()).select("record_no", "target_uri", "host")


def document_frequency_job(i: Inputs) -> DataFrame:
    return document_frequency(i.terms())


def term_frequency_job(i: Inputs) -> DataFrame:
    return term_frequency(i.terms())


def term_frequency_short_words(i: Inputs) -> DataFrame:
    """Words cut to eight characters: those that become equal are counted together."""
    return term_frequency(term_counts(i.marked(), i.dictionary(), limit=8))


def distinct_links(i: Inputs) -> DataFrame:
    return link_rows(i.marked().filter("is_latest"))


def latest_page(i: Inputs) -> DataFrame:
    pages = i.table("pages").select(
        url_host(F.col("url")).alias("host"), archive_of(F.col("page_id")).alias("file_id"),
        F.col("page_id").alias("record_no"), "url",
    )
    return latest_pages(pages, "host", filter_from=0)


def scan_counters_job(i: Inputs) -> DataFrame:
    records = i.varied_records().withColumn("file_id", archive_of(F.col("record_no")))
    return scan_counters(records, i.allowlist(), i.model)


def postings_with_ids(i: Inputs) -> DataFrame:
    """Postings by surrogate id, then read back by natural key. Ids are given out
    once and stored, as everything that refers to them must see the same ones."""
    postings = i.spark.read.parquet(
        i.stored("postings", lambda path: term_frequency(i.terms()).write.mode("overwrite").parquet(path))
    )

    def ids(key: str, name: str) -> Lookup:
        path = i.stored(name, lambda path: dense_ids(postings, key, name).write.mode("overwrite").parquet(path))
        return checked_lookup(i.spark.read.parquet(path), IDS_BROADCAST)

    words, urls = ids("word", "keyword_id"), ids("url", "website_id")
    return postings_by_key(postings_by_id(postings, words, urls), words, urls)


def dense_ids_job(i: Inputs) -> DataFrame:
    words = i.documents().select(F.explode(tokens(F.col("text"))).alias("word"))
    return dense_ids(words, "word").agg(
        F.count(F.lit(1)).alias("n"), F.min("id").alias("first_id"), F.max("id").alias("last_id"),
        F.count_distinct("id").alias("distinct_ids"), F.count_distinct("word").alias("distinct_words"),
    )


def stable_ids(i: Inputs) -> DataFrame:
    """Words of the documents numbered in three batches: how many are known after each, how many of them have another
    id at the end, and how many ids are given twice."""
    words = i.documents().select(F.col("doc_id") % 3, F.explode(tokens(F.col("text"))).alias("word"))
    words = words.toDF("batch", "word")
    ids = StableIds(i.spark, f"{i.scratch}/ids-{uuid.uuid4().hex}", "word")
    known = []
    for batch in range(3):
        ids.extend(words.filter(F.col("batch") == batch))
        known.append(ids.known())
    last = known[-1].withColumnRenamed("id", "last_id")
    rows = [
        then.join(last, "word", "left").agg(
            F.lit(batch).alias("batch"), F.count(F.lit(1)).alias("words"),
            F.count_if(~F.col("id").eqNullSafe(F.col("last_id"))).alias("changed"),
            (F.count(F.lit(1)) - F.count_distinct("id")).alias("repeated"),
        )
        for batch, then in enumerate(known)
    ]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


# --- merges -----------------------------------------------------------------------------


def replace_children_job(i: Inputs) -> DataFrame:
    """Lines of orders in state P are replaced; those with a large quantity are gone."""
    lines = i.table("lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    batch = i.table("orders").filter(F.col("o_orderstatus") == "P").select(F.col("o_orderkey").alias("l_orderkey"))
    new = lines.join(batch, "l_orderkey", "left_semi").filter(F.col("l_quantity") < 25)
    new = new.withColumn("l_quantity", F.col("l_quantity") + 1000)
    return replace_children(lines, new, batch, ["l_orderkey"])


def insert_if_absent_job(i: Inputs) -> DataFrame:
    old = i.table("customer").filter(F.col("c_acctbal") > 0).select("c_custkey", F.lit("old").alias("origin"))
    new = i.table("orders").select(F.col("o_custkey").alias("c_custkey"), F.lit("new").alias("origin"))
    return insert_if_absent(old, new, ["c_custkey"])


def upsert_websites(i: Inputs) -> DataFrame:
    return merge_index(*i.site_indexes()).websites


def replace_postings(i: Inputs) -> DataFrame:
    return merge_index(*i.site_indexes()).postings


def replace_links(i: Inputs) -> DataFrame:
    return merge_index(*i.site_indexes()).links


def df_accumulate(i: Inputs) -> DataFrame:
    """Document frequencies of all archives, duplicates between archives counted twice."""
    return i.keywords()


def df_recomputed(i: Inputs) -> DataFrame:
    return recompute_keywords(merge_index(*i.site_indexes()).postings)


def ledger_seed(i: Inputs) -> DataFrame:
    return seed_ledger(i.ledger_names())


def ledger_mark(i: Inputs) -> DataFrame:
    return i.marked_ledger()


def ingested(i: Inputs) -> IndexStore:
    """All archives through the stream, a third of them per batch, into a new store."""
    def run(path: str) -> None:
        archives = -(-i.table("pages").count() // PAGES_PER_ARCHIVE)
        query = ingest_stream(
            i.spark, i.archives(), IndexStore(i.spark, path), path + "/checkpoint", i.allowlist(), i.dictionary(),
            i.model, max_files=max(1, -(-archives // 3)), file_id=archive_in,
        )
        query.awaitTermination()

    return IndexStore(i.spark, i.stored("ingested", run))


def ingest_after_merge(i: Inputs) -> DataFrame:
    """Postings after archives were added one by one, merged by size, merged whole and cleaned."""
    def run(path: str) -> None:
        store = IndexStore(i.spark, path)
        store.seed(archive_paths(i.spark, i.archives()).select(F.col("path").alias("file_name")))
        step = -(-store.pending().count() // 5)
        while ingest_pending(store, i.allowlist(), i.dictionary(), i.model, step, archive_in):
            pass
        store.compact()
        store.clean(grace=0)

    return IndexStore(i.spark, i.stored("merged", run)).read().postings


def incremental_ingest(i: Inputs) -> DataFrame:
    return ingested(i).read().keywords


def ingested_postings(i: Inputs) -> DataFrame:
    return ingested(i).read().postings


def ingested_websites(i: Inputs) -> DataFrame:
    return ingested(i).read().websites


def ingested_links(i: Inputs) -> DataFrame:
    return ingested(i).read().links


def ingest_report(i: Inputs) -> DataFrame:
    """Counters of all batches of the ingest, and what was left to do after the last."""
    totals = [F.sum(c).alias(c) for c in ("records_read", "records_matching", "records_damaged", "pages_valid", "pages_added")]
    return ingested(i).reports().agg(*totals, F.max_by("files_left", "version").alias("files_left"))


def ledger_after_ingest(i: Inputs) -> DataFrame:
    return ingested(i).files().select(archive_in(F.col("file_name")).alias("file_id"), "processed")


# --- audits and lookups --------------------------------------------------------------------


def audit_unique_job(i: Inputs) -> DataFrame:
    return audit_unique(i.table("lineitem"), ["l_orderkey", "l_linenumber"])


def audit_fk_job(i: Inputs) -> DataFrame:
    urgent = i.table("orders").filter(F.col("o_orderpriority") != "5-LOW")
    lines = i.table("lineitem").select("l_orderkey", "l_linenumber")
    return audit_fk(lines, urgent, "l_orderkey", "o_orderkey")


def audit_not_null_job(i: Inputs) -> DataFrame:
    joined = i.table("documents").join(i.table("labels"), "doc_id", "left")
    return audit_not_null(joined, ["doc_id", "text", "lang", "quality", "toxic"])


def audit_index_job(i: Inputs) -> DataFrame:
    return ingested(i).audit()


def audit_delta_job(i: Inputs) -> DataFrame:
    """What each batch of the ingest has added, summed up: the same as an audit of the whole."""
    store = ingested(i)
    found = [store.audit(s["id"]) for s in store.current()["segments"]]
    return reduce(DataFrame.unionByName, found).groupBy("check").agg(F.sum("violations").alias("violations"))


def postings_lookup(i: Inputs) -> DataFrame:
    return ingested(i).postings_of(["the", "tion", "es"], min_occurrences=2)


def keywords_by_df_job(i: Inputs) -> DataFrame:
    return ingested(i).keywords_by_df(2, 20)


def top_keywords(i: Inputs) -> DataFrame:
    return ingested(i).top_keywords(50)


def inlink_count(i: Inputs) -> DataFrame:
    return ingested(i).inlink_counts()


def outlinks(i: Inputs) -> DataFrame:
    return ingested(i).outlink_counts()


def website_table(i: Inputs) -> DataFrame:
    return website_rows(i.marked().filter("is_latest"))


JOBS = {
    "line_prefix": line_prefix,
    "allowlist_hosts": allowlist_hosts,
    "lemma_dictionary": lemma_dictionary_job,
    "warc_scan": warc_scan,
    "warc_data_source": warc_data_source,
    "warc_corrupt_rows": warc_corrupt_rows,
    "record_headers": record_headers,
    "file_number": file_number_job,
    "ledger_pending": ledger_pending,
    "url_host": url_host_job,
    "utf8_valid": utf8_valid,
    "content_type": content_type_job,
    "status_code": status_code_job,
    "filter_html": filter_html,
    "html_body": html_body,
    "page_title": page_title,
    "page_description": page_description,
    "visible_text_tokens": visible_text_tokens,
    "page_links": page_links,
    "language_weights": language_weights_job,
    "detect_language": detect_language_job,
    "tokens": tokens_job,
    "lemmatised_tokens": lemmatised_tokens,
    "keyword_truncate": keyword_truncate,
    "word_count": word_count_job,
    "parse_pages": parse_pages_job,
    "filter_english": filter_english,
    "indexable_pages": indexable_pages,
    "allowlist_semi_join": allowlist_semi_join,
    "document_frequency": document_frequency_job,
    "term_frequency": term_frequency_job,
    "term_frequency_short_words": term_frequency_short_words,
    "distinct_links": distinct_links,
    "latest_page": latest_page,
    "website_table": website_table,
    "scan_counters": scan_counters_job,
    "postings_with_ids": postings_with_ids,
    "dense_ids": dense_ids_job,
    "stable_ids": stable_ids,
    "replace_children": replace_children_job,
    "insert_if_absent": insert_if_absent_job,
    "upsert_websites": upsert_websites,
    "replace_postings": replace_postings,
    "replace_links": replace_links,
    "df_accumulate": df_accumulate,
    "df_recomputed": df_recomputed,
    "ledger_seed": ledger_seed,
    "ledger_mark": ledger_mark,
    "incremental_ingest": incremental_ingest,
    "ingest_after_merge": ingest_after_merge,
    "ingested_postings": ingested_postings,
    "ingested_websites": ingested_websites,
    "ingested_links": ingested_links,
    "ingest_report": ingest_report,
    "ledger_after_ingest": ledger_after_ingest,
    "audit_unique": audit_unique_job,
    "audit_fk": audit_fk_job,
    "audit_not_null": audit_not_null_job,
    "audit_index": audit_index_job,
    "audit_delta": audit_delta_job,
    "postings_lookup": postings_lookup,
    "keywords_by_df": keywords_by_df_job,
    "top_keywords": top_keywords,
    "inlink_count": inlink_count,
    "outlinks": outlinks,
}
