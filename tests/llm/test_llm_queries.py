"""The registered queries against their SQL, and the pipeline stage by stage against brute force."""

import glob
import os
import sys
from collections import Counter
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

import __spark_entry__ as entry
import corpus_pipeline
from test_operators import groups_by_hand, leaks_by_hand, spans_by_hand
from webloom.llm.queries import QUERIES, SQL

TABLES = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for path in glob.glob(f"{TABLES}/*.parquet"):
        connection.execute(f"CREATE VIEW {os.path.basename(path).removesuffix('.parquet')} AS SELECT * FROM '{path}'")
    return connection


def test_all_queries_are_registered():
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())
    assert {q.split("_")[0] for q in QUERIES} == {"pipeline", *(f"op{n}" for n in range(1, 14))}


@pytest.mark.parametrize("name", SQL)
def test_query_equals_sql(spark, db, name):
    found = QUERIES[name](spark, TABLES)
    expected = db.execute(SQL[name])
    columns = [c[0] for c in expected.description]
    assert sorted(found.columns) == sorted(columns)
    order = [found.columns.index(c) for c in columns]
    assert Counter(repr([r[i] for i in order]) for r in found.collect()) == Counter(repr(list(r)) for r in expected.fetchall())


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{TABLES}/documents.parquet")
    benchmark = [tuple(r) for r in spark.read.parquet(f"{TABLES}/benchmark.parquet").select("item_id", "text").collect()]
    before = {r.doc_id: r for r in docs.collect()}
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        frame = spark.createDataFrame(list(before.values()), docs.schema)
        result = stage(spark, frame, TABLES)
        after = {r.doc_id: r for r in result.collect()}
        if number < len(corpus_pipeline.STAGES) - 1:
            assert result.columns == docs.columns
        texts = [(d, r.text) for d, r in before.items()]
        if name == "near_duplicates":
            assert set(after) == {d for d, (_, c) in groups_by_hand(texts, 5, 8, 10).items() if c == d}
        elif name == "decontamination":
            assert set(after) == {r[0] for r in leaks_by_hand(texts, benchmark) if not r[5]}
        elif name == "personal_data":
            assert set(after) == set(before)
            assert not any(spans_by_hand(r.text) for r in after.values())
            assert all(r.n_chars == len(r.text) for r in after.values())
        elif name == "toxicity":
            assert len(after) > 0.8 * len(before) and all(after[d] == before[d] for d in after)
        elif name == "mixing":
            assert sum(r.taken for r in after.values()) == pytest.approx(1.5 * sum(len(r.text.split()) for r in before.values()), rel=0.01)
        before = after if number < len(corpus_pipeline.STAGES) - 1 else before


def test_stages_on_nulls_and_empty_tables(spark, tmp_path):
    schema = spark.read.parquet(f"{TABLES}/documents.parquet").schema
    rows = [(1, "idiot " * 20, "en", "a", 120), (None, None, None, None, None), (2, "", "en", None, 0), (3, "x " * 9000, "en", "a", 18000)]
    for table in (rows, []):
        frame = spark.createDataFrame(table, schema)
        for _, stage in corpus_pipeline.STAGES:
            frame = spark.createDataFrame(stage(spark, frame, TABLES).select(*schema.names).collect(), schema)


def test_run_over_the_whole_table(spark):
    result = corpus_pipeline.run(spark, TABLES)
    assert result.count() > 100 and result.filter(F.col("taken") > 2 * F.col("size")).count() == 0
