"""One registered query for each operator, over whole tables with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casewright.llm import (chat_format, collocations, decontamination, exact_dedup, html_extract, language_id, merkle, mixing, simhash,
                            substring_dedup, suffix_dedup, url_filter, warc)
from casewright.llm.common import documents, table


def op1_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    training = docs.filter(F.col("lang").isNotNull() & ~language_id.held_out(F.col("doc_id")))
    model = language_id.train(training.select("text", "lang"))
    return language_id.predict(docs, model).select(
        "doc_id", language_id.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected")


def op2_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontamination.contained_items(documents(spark, folder), table(spark, folder, "benchmark"))
    return found.select("doc_id", "item_id", "shared", "item_shingles")


def op3_html_extract(spark: SparkSession, folder: str) -> DataFrame:
    return html_extract.extracted(table(spark, folder, "pages")).select(
        "page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op4_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.taken_words(documents(spark, folder))


def op5_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_duplicates(documents(spark, folder))


def op6_warc_revisits(spark: SparkSession, folder: str) -> DataFrame:
    found = warc.resolve(warc.records_of_pages(table(spark, folder, "pages")))
    headers = F.array_join(F.array_sort(F.transform(F.map_entries("headers"), lambda e: F.concat(
        e["key"], F.lit(": "), e["value"]))), "\n")
    return found.select("record_id", "url_key", "outcome", "source", headers.alias("headers"),
                        F.sha2("body", 256).alias("body_sha256"))


def op7_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substring_dedup.without_repeats(documents(spark, folder), digest=True)


def op8_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, folder)).select("doc_id", "fingerprint", "component_id")


def op9_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.judged(table(spark, folder, "pages"))


def op10_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.without_repeats(documents(spark, folder), digest=True)


def op11_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    told = table(spark, folder, "conversations").select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    hard = "</s>[INST] ok [/INST]"
    example = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(hard).alias("text"))
    folded = chat_format.fold(chat_format.log_of_turns(told.unionByName(example)))
    read = chat_format.read_back(chat_format.render(folded))
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    trained = F.array_join("trained", "")
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(turns, 256).alias("turns_sha256"),
        F.char_length(trained).cast("long").alias("loss_chars"), F.sha2(trained, 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"))


def op12_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return merkle.verified(documents(spark, folder))


def op13_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(documents(spark, folder))


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)


QUERIES = {f.__name__: f for f in (
    op1_language_id, op2_decontamination, op3_html_extract, op4_mixing, op5_exact_dedup,
    op6_warc_revisits, op7_substring_dedup, op8_simhash, op9_url_filter, op10_suffix_dedup, op11_chat_format,
    op12_merkle_manifest, op13_collocations, pipeline)}
