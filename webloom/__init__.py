"""Crawl archives to search index and link graph, as PySpark DataFrame jobs."""

from pyspark import cloudpickle as _cloudpickle
import sys as _sys

# Ship this package's functions inside the job, so executors need no install.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])

from webloom.functions.http import html_responses, response_parts  # noqa: E402
from webloom.functions.text import tokens, truncate_word  # noqa: E402
from webloom.functions.urls import url_host  # noqa: E402
from webloom.operators.audit import audit_fk, audit_not_null, audit_unique  # noqa: E402
from webloom.operators.hosts import filter_hosts, site_allowlist  # noqa: E402
from webloom.operators.language import LanguageModel, detect_language, train_language_model  # noqa: E402
from webloom.operators.lemmas import lemma_dictionary, lemmatise, lemmatise_rows  # noqa: E402
from webloom.plans.index import Index, build_index, merge_index  # noqa: E402
from webloom.plans.store import IndexStore  # noqa: E402
from webloom.plans.pages import parse_pages  # noqa: E402
from webloom.sources.lines import read_lines  # noqa: E402
from webloom.sources.warc import read_warc, register_warc_source, scan_archives  # noqa: E402
from webloom.streaming.ingest import ingest_stream  # noqa: E402

__all__ = [
    "Index", "IndexStore", "LanguageModel", "audit_fk", "audit_not_null", "audit_unique",
    "build_index", "detect_language", "filter_hosts", "ingest_stream", "lemma_dictionary",
    "lemmatise", "lemmatise_rows", "merge_index", "parse_pages", "read_lines", "read_warc",
    "register_warc_source", "html_responses", "response_parts", "scan_archives",
    "site_allowlist", "tokens", "train_language_model", "truncate_word", "url_host",
]
