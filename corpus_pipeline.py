"""A corpus from raw documents to a training mix, stage by stage.

Stages: language identification (rejected texts go), exact duplicates (the row with the largest id stays), near
duplicates by SimHash (the document with the smallest id of each group stays), benchmark decontamination, and mixing of the
sources to their target weights. Every stage takes what its predecessor kept, as written and read again.

Defined cases, beside those of the operators: wholly repeated rows count as one document from the second stage on;
rows that share an id and differ in text are different documents all the way; extra columns are carried along, whatever their
names (but the mix has its own ``copy``, ``finish`` and ``words`` in place of columns of these names).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casewright.llm import decontamination, exact_dedup, language_id, mixing, simhash
from casewright.llm.common import ascii_lower, settle, table

#: SQL cannot state the language models or XXH64; the stages are tested against brute force.
ORACLE_SQL = None


def _where(docs: DataFrame, keys: DataFrame, how: str, text_hash: Column | None = None) -> DataFrame:
    """Rows of ``docs`` with (or without) a partner in ``keys`` (doc_id, text_hash); a null id equals itself."""
    hashed = F.xxhash64("d.text") if text_hash is None else text_hash
    same = F.col("d.doc_id").cast("long").eqNullSafe(F.col("k.doc_id")) & (hashed == F.col("k.text_hash"))
    return docs.alias("d").join(keys.select("doc_id", "text_hash").alias("k"), same, how)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    training = docs.filter(F.col("lang").isNotNull() & ~language_id.held_out(F.col("doc_id")))
    model = language_id.train(training.select("text", "lang"))
    judged = language_id.predict(docs, model)
    return _where(docs, judged.filter("rejected").select("doc_id", "text_hash").distinct(), "left_anti")


def drop_exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = exact_dedup.exact_duplicates(docs)
    kept = found.filter("kept").select("doc_id", F.col("text_sha256").alias("text_hash"))
    return _first_rows(_where(docs, kept, "left_semi", _digest("d.text")), docs)


def _digest(text: str) -> Column:
    return F.sha2(ascii_lower(F.coalesce(F.col(text), F.lit(""))), 256)


def _first_rows(staying: DataFrame, docs: DataFrame) -> DataFrame:
    """One row of each id and text of ``staying``: rows that repeat both differ at most in other columns.

    ``docs`` has the same rows before any join; which ids repeat is read there, and only those rows move.
    """
    several = settle("repeated-rows", docs.select("doc_id", _digest("text").alias("text_hash")).groupBy(
        "doc_id", "text_hash").count().filter("count > 1").drop("count"))
    if several.isEmpty():
        return staying
    sha = "digest"
    while sha in map(str.lower, staying.columns):
        sha += "_"
    repeated = _where(staying, several, "left_semi", _digest("d.text")).withColumn(sha, _digest("text")).dropDuplicates(["doc_id", sha])
    return _where(staying, several, "left_anti", _digest("d.text")).union(repeated.drop(sha))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(docs.select("doc_id", "text"))
    kept = found.filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(
        "doc_id", F.col("text_hash")).distinct()
    return _where(docs, kept, "left_semi")


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "benchmark")
    found = decontamination.contained_items(docs, items)
    return _where(docs, found.select("doc_id", "text_hash").distinct(), "left_anti")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a row for each copy of a document, with ``copy``, ``finish`` (place in the mix) and ``words`` taken."""
    taken = [F.col(f"d.`{c}`") for c in docs.columns if c.lower() not in ("copy", "finish", "words")]
    copies = settle("mix", mixing.schedule(docs, ordered=False)).distinct().alias("m")
    same = F.col("d.doc_id").eqNullSafe(F.col("m.doc_id")) & (F.xxhash64("d.text") == F.col("m.text_hash"))
    return docs.alias("d").join(copies, same).select(*taken, "m.copy", "m.finish", "m.words")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact_duplicates),
    ("simhash_near_dedup", drop_near_duplicates),
    ("decontamination", drop_benchmark_leaks),
    ("mixing", mix_sources),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = settle(name, stage(spark, docs, sf_dir))
    return docs
