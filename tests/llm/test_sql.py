"""The text queries against their SQL counterparts in DuckDB."""

from collections import Counter
from pathlib import Path

import duckdb
import pytest

import corpus_pipeline
from tickloom.llm.queries import ORACLE, QUERIES

FOLDER = "/root/testdata/sf0.001"
SQL = ORACLE | {"pipeline": corpus_pipeline.ORACLE_SQL}
BUILDS = QUERIES | {"pipeline": corpus_pipeline.run}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in Path(FOLDER).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, duck, name):
    df = BUILDS[name](spark, FOLDER)
    columns = sorted(df.columns)
    assert sorted(duck.sql(SQL[name]).columns) == columns
    got = Counter(tuple(r) for r in df.select(*columns).collect())
    want = Counter(duck.sql(f"SELECT {', '.join(columns)} FROM ({SQL[name]})").fetchall())
    assert got == want and got


def test_queries_without_sql_are_tested_elsewhere():
    assert set(QUERIES) - set(SQL) == {"op3_html_extraction", "op5_suffix_dedup", "op8_toxicity", "op11_embedding_whitening"}


def test_stages_keep_the_columns(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    for _, step in corpus_pipeline.STAGES[:-1]:
        assert step(spark, docs, small).columns == docs.columns


def test_clean_documents_pass_the_quality_rules(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    labels = spark.read.parquet(f"{small}/labels.parquet")
    kept = corpus_pipeline.quality_rules(spark, docs, small)
    ids = {r.doc_id for r in kept.select("doc_id").collect()}
    long_enough = {r.doc_id for r in docs.where("size(split(text, ' ')) >= 60").select("doc_id").collect()}
    clean = {r.doc_id for r in labels.where("quality = 1").collect()} & long_enough
    assert clean and clean <= ids
