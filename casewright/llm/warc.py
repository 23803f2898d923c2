"""Resolution of not-modified revisit records in web archives.

A crawler that gets "304 Not Modified" stores a revisit record without a body. Its content is the latest earlier full
response of the same canonical url, provided that the validators agree; the stored headers are updated by those of the
revisit, except the ones that describe the body.

Defined cases: a record without url has the empty canonical url, like all others of its kind. Of full responses at the same
time the one with the largest record id is the later one; one at the very time of the revisit is not earlier. A null
date is earlier than all others. A revisit without an earlier full response is an ``orphan``; with differing validators
a ``mismatch``, without common validators ``unverified``: these keep their own headers and have no body. Rows that
repeat are resolved each, to one row each. Of full responses that share a record id the one with the latest date, then the largest
digest of the body, speaks for the id; revisits that share one are told apart by url and date. A record without id
is resolved like others, but no record can refer to a response without one: its revisits are orphans. An empty table gives an
empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casewright.llm.common import ascii_lower, settle

#: Header fields that a 304 response may not change in a stored response.
NOT_UPDATED = ("connection", "content-encoding", "content-length", "content-range", "content-type", "etag",
               "keep-alive", "proxy-authenticate", "proxy-authorization", "te", "trailer", "transfer-encoding", "upgrade")
#: Query parameters that name the visitor's way and not the page.
TRACKING = ("fbclid", "gclid", "ref", "utm_campaign", "utm_content", "utm_medium", "utm_source", "utm_term")
RECORDS = "record_id long, url string, date timestamp, type string, status int, headers map<string,string>, body string"


def canonical_url(url: Column) -> Column:
    """Host in lower case without ``www.`` and default port, path without a closing slash, query without tracking
    parameters and in order, no scheme and no fragment."""
    bare = F.regexp_replace(F.regexp_replace(F.coalesce(url, F.lit("")), r"#[\s\S]*\z", ""), r"\A[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.regexp_replace(ascii_lower(F.regexp_extract(bare, r"\A[^/?]*", 0)), r"\Awww\.|:(80|443)\z", "")
    path = F.regexp_replace(F.regexp_extract(bare, r"\A[^/?]*([^?]*)", 1), r"/+\z", "")
    query = F.regexp_extract(bare, r"\A[^?]*\?([\s\S]*)\z", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~F.split(p, "=")[0].isin(*TRACKING)))
    return F.concat(host, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(F.lit("")))


def _is_full(kind: Column, status: Column) -> Column:
    return F.coalesce((kind == "response") & (status == 200), F.lit(False))


def latest_full(records: DataFrame) -> DataFrame:
    """(record_id, key, at, source): for each revisit the latest earlier full response of its canonical url, or null.

    Records are range-partitioned by (url, date, id), so that a url with very many captures spreads over tasks, and
    each task carries the last full response forward. What has to cross the borders is one row per partition.
    """
    spark = records.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    full = _is_full(F.col("type"), F.col("status"))
    light = records.select(
        canonical_url(F.col("url")).alias("key"), _at(F.col("date")).alias("at"), "record_id",
        full.alias("full"), F.coalesce(F.col("type") == "revisit", F.lit(False)).alias("revisit")
    ).filter("full or revisit")
    # At equal times revisits come first: a full response of the same moment is not earlier.
    order = ["key", "at", "full", "record_id"]
    ranged = settle("captures", light.repartitionByRange(partitions, *order).sortWithinPartitions(*order)
                    .mapInPandas(_carry, "record_id long, at long, revisit boolean, source long, key string, open boolean, tail boolean, "
                                         "first_key string, piece int"))
    tails = sorted(ranged.filter("tail").select("piece", "first_key", "key", "source", "open").collect(),
                   key=lambda r: r["piece"])  # one row per partition
    carried, last = {}, (None, None)
    for tail in tails:
        if last[0] is not None and tail["first_key"] == last[0] and last[1] is not None:
            carried[tail["piece"]] = last[1]
        source = tail["source"]
        if tail["open"] and tail["first_key"] == tail["key"]:  # all of one url, no full response yet
            source = carried.get(tail["piece"])
        last = (tail["key"], source)
    borders = spark.createDataFrame([(p, s) for p, s in carried.items()], "piece int, border long")
    return ranged.filter("revisit and not tail").join(F.broadcast(borders), "piece", "left").select(
        "record_id", "key", "at", F.when(F.col("open") & (F.col("key") == F.col("first_key")), F.col("border"))
        .otherwise(F.col("source")).alias("source"))


def _carry(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    from pyspark import TaskContext

    piece = TaskContext.get().partitionId()
    key = first_key = source = None
    for batch in batches:
        if not len(batch):
            continue
        if first_key is None:
            first_key = batch["key"].iloc[0]
        own = batch["record_id"].where(batch["full"]).astype("Int64")
        # Within a url forward; the first url of the batch goes on from the batch before.
        filled = own.groupby(batch["key"], sort=False).ffill()
        if source is not None:
            goes_on = (batch["key"] == key) & filled.isna()
            filled = filled.mask(goes_on, source)
        key = batch["key"].iloc[-1]
        source = None if pd.isna(filled.iloc[-1]) else int(filled.iloc[-1])
        yield pd.DataFrame({"record_id": batch["record_id"], "at": batch["at"], "revisit": batch["revisit"], "source": filled,
                            "key": batch["key"], "open": filled.isna(), "tail": False, "first_key": first_key,
                            "piece": piece})
    if first_key is not None:
        yield pd.DataFrame({"record_id": [0], "at": [0], "revisit": [False], "source": pd.array([source], "Int64"), "key": [key],
                            "open": [source is None], "tail": [True], "first_key": [first_key], "piece": [piece]})


def _weak(tag: Column) -> Column:
    return F.regexp_replace(tag, r"\A[Ww]/", "")


def _at(date: Column) -> Column:
    return F.coalesce(F.unix_micros(date), F.lit(-(1 << 62)))


def _one_each(full: DataFrame) -> DataFrame:
    """One full response for each record id. Only ids that repeat are looked at again, so other bodies do not move for it."""
    several = settle("repeated-records", full.groupBy("record_id").count().filter("count > 1").select("record_id"))
    if not several.isEmpty():
        order = Window.partitionBy("record_id").orderBy(F.desc(_at(F.col("date"))), F.desc(F.sha2("body", 256)), F.desc(F.md5(F.array_join(
            F.array_sort(F.transform(F.map_entries("headers"), lambda e: F.concat_ws("=", e["key"], e["value"]))), "\n"))))
        chosen = full.join(several, "record_id", "left_semi").withColumn("__n", F.row_number().over(order)).filter("__n = 1").drop("__n")
        full = full.join(several, "record_id", "left_anti").select("record_id", "headers", "body").union(
            chosen.select("record_id", "headers", "body"))
    return full.select("record_id", "headers", "body")


def resolve(records: DataFrame) -> DataFrame:
    """One row per response or revisit record: record_id, url_key, outcome (full, resolved, mismatch, unverified, orphan),
    source (record the body is from), headers (merged), body."""
    found = latest_full(records).distinct()
    # Bodies move once: those of stored responses to the revisits that they answer. Responses are read as they are.
    own = records.filter(F.col("type") == "response").select(
        "record_id", canonical_url(F.col("url")).alias("url_key"), F.lit("full").alias("outcome"),
        F.lit(None).cast("long").alias("source"), "headers", "body")
    asked = records.filter(F.col("type") == "revisit").select(
        "record_id", "url", "headers", canonical_url(F.col("url")).alias("key"), _at(F.col("date")).alias("at"))
    same = F.col("q.record_id").eqNullSafe(F.col("f.record_id")) & (F.col("q.key") == F.col("f.key")) & (F.col("q.at") == F.col("f.at"))
    mine = asked.alias("q").join(found.alias("f"), same, "left").select("q.record_id", "q.url", "q.headers", "f.source").alias("r")
    stored = _one_each(records.filter(_is_full(F.col("type"), F.col("status")))).alias("s")
    both = mine.join(stored, F.col("r.source") == F.col("s.record_id"), "left")
    field = lambda side, name: F.element_at(F.col(f"{side}.headers"), name)
    tags = field("r", "etag").isNotNull() & field("s", "etag").isNotNull()
    dates = field("r", "last-modified").isNotNull() & field("s", "last-modified").isNotNull()
    agreed = lambda same: F.when(same, F.lit("resolved")).otherwise(F.lit("mismatch"))
    outcome = (
        F.when(F.col("s.record_id").isNull(), F.lit("orphan"))
        .when(tags, agreed(_weak(field("r", "etag")) == _weak(field("s", "etag"))))
        .when(dates, agreed(field("r", "last-modified") == field("s", "last-modified")))
        .otherwise(F.lit("unverified"))
    )
    empty = F.create_map().cast("map<string,string>")
    new = F.map_filter(F.coalesce(F.col("r.headers"), empty), lambda k, v: ~k.isin(*NOT_UPDATED))
    old = F.map_filter(F.coalesce(F.col("s.headers"), empty), lambda k, v: ~F.map_contains_key(new, k))
    resolved = F.col("outcome") == "resolved"
    answered = both.withColumn("outcome", outcome).select(
        F.col("r.record_id").alias("record_id"), canonical_url(F.col("r.url")).alias("url_key"), "outcome",
        F.when(resolved, F.col("s.record_id")).alias("source"),
        F.when(resolved, F.map_concat(old, new)).otherwise(F.col("r.headers")).alias("headers"),
        F.when(resolved, F.col("s.body")).alias("body"))
    return own.union(answered)


def records_of_pages(pages: DataFrame) -> DataFrame:
    """Archive records of the pages table: each page as a full response, and a revisit a day later.

    Validators depend on the page: every seventh revisit has another tag, every fifth only a date, every eleventh none.
    """
    n = F.col("page_id")
    seconds = F.pmod(n * 7919, F.lit(100_003)) * 60
    at = F.timestamp_seconds(F.lit(1_600_000_000) + seconds)
    # The same text in every session time zone.
    day = F.date_format(F.timestamp_add("SECOND", seconds, F.lit("2020-09-13 12:26:40").cast("timestamp_ntz")),
                        "yyyy-MM-dd HH:mm:ss")
    tag = F.substring(F.md5(F.coalesce("html", F.lit(""))), 1, 16)
    texts = lambda *pairs: F.map_filter(F.create_map(*[x for k, v in pairs for x in (F.lit(k), v)]),
                                        lambda k, v: v.isNotNull())
    full = pages.select(
        (n * 2).alias("record_id"), "url", at.alias("date"), F.lit("response").alias("type"), F.lit(200).alias("status"),
        texts(("content-type", F.lit("text/html")), ("content-length", F.octet_length("html").cast("string")),
              ("etag", tag), ("last-modified", day), ("cache-control", F.lit("max-age=60"))).alias("headers"),
        F.col("html").alias("body"))
    revisit = pages.select(
        (n * 2 + 1).alias("record_id"), "url", (at + F.expr("interval 1 day")).alias("date"),
        F.lit("revisit").alias("type"), F.lit(304).alias("status"),
        texts(("etag", F.when(n % 11 == 0, F.lit(None)).when(n % 5 == 0, F.lit(None)).when(n % 7 == 0, F.lit("other"))
               .otherwise(F.concat(F.lit("W/"), tag))),
              ("last-modified", F.when(n % 11 == 0, F.lit(None)).otherwise(day)),
              ("content-length", F.lit("0")), ("cache-control", F.lit("max-age=600"))).alias("headers"),
        F.lit(None).cast("string").alias("body"))
    return full.union(revisit)
