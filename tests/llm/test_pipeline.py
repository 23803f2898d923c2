"""The pipeline: stages on awkward documents, and the registered queries against their SQL."""

from __future__ import annotations

import random

import duckdb
import pytest

import corpus_pipeline
from casewright.llm import sql
from casewright.llm.queries import QUERIES
from tests.compare import normal

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def folder(tmp_path_factory, spark):
    rng = random.Random(11)
    text = lambda n: " ".join(f"{rng.choice('bdgklm')}{rng.choice('aeiou')}{rng.choice('nrst')}{rng.randrange(9)}" for _ in range(n))
    base = text(400)
    leak = text(40)
    rows = [(i, text(60), "en" if i % 2 else None, f"s{i % 3}", 1) for i in range(40)]
    rows += [(50, base, "en", "s1", 1), (51, base.upper(), "en", "s1", 1), (51, base.upper(), "en", "s1", 1), (52, base + " end", "en", None, None),
             (60, f"{text(30)} {leak} {text(30)}", "en", "s2", 1), (70, None, None, None, None), (71, "", "en", "s1", 0), (72, "123", "en", "s1", 0)]
    path = tmp_path_factory.mktemp("docs")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, leak), (2, None)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path)


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, before = docs.columns, {r.doc_id for r in docs.collect()}
    kept = {}
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs = corpus_pipeline.settle(name, stage(spark, docs, folder))
        if number < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns
        kept[name] = [r.doc_id for r in docs.collect()]
    assert before - set(kept["language_id"]) == {70, 71, 72}
    assert set(kept["language_id"]) - set(kept["exact_dedup"]) == {50} and kept["exact_dedup"].count(51) == 1
    assert set(kept["exact_dedup"]) - set(kept["simhash_near_dedup"]) == {52}
    assert set(kept["simhash_near_dedup"]) - set(kept["decontamination"]) == {60}
    assert set(kept["mixing"]) <= set(kept["decontamination"]) and docs.agg({"words": "sum"}).first()[0] > 0


def test_pipeline_of_no_documents(spark, folder, tmp_path):
    spark.read.parquet(f"{folder}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{folder}/benchmark.parquet").limit(0).write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


@pytest.mark.parametrize("name", sorted(sql.ORACLE_SQL))
def test_query_equals_sql(spark, name):
    db = duckdb.connect()
    for table in ("documents", "pages", "benchmark", "conversations"):
        db.sql(f"create view {table} as select * from '{DATA}/{table}.parquet'")
    want = db.sql(sql.ORACLE_SQL[name])
    got = QUERIES[name](spark, DATA)
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    assert normal(got.columns, got.collect()) == normal(want.columns, want.fetchall())


def test_stages_carry_columns_of_any_name(spark, folder):
    """Columns called like those that the stages use inside."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    names = ("words", "copy", "finish", "__id", "__hash", "__sha", "digest", "text_hash", "component_id", "size", "a.b", "Target", "k", "d")
    for n, name in enumerate(names):
        docs = docs.withColumn(name, docs["doc_id"] * 0 + n)
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = corpus_pipeline.settle(name, stage(spark, docs, folder))
        if number < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == docs.columns
        docs = out
    row = docs.first()
    assert {n: row[n] for n in names if n not in ("words", "copy", "finish")} == {
        name: n for n, name in enumerate(names) if name not in ("words", "copy", "finish")}
    assert row["copy"] in (1, 2, 3) and row["words"] > 0 and docs.columns.count("words") == 1
