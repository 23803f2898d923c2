"""Near duplicates by SimHash fingerprints and pigeonhole blocks.

Defined cases: a null text has no words; a text without words has fingerprint zero and links like any other; a text
with fewer words than a shingle is one shingle. Rows that repeat an id and a text give a row each. Ties between bits
(set in exactly half the shingles) count as not set. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casewright.llm.common import settle
from casewright.llm.components import components

SHINGLE_WORDS = 4
MOST_BITS = 4
SEED = 42
#: Buckets of up to so many fingerprints are compared pair by pair; both ways give the same links.
COMPARED = 1000
HASHED_AT_ONCE = 1 << 16


def fingerprint(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """The SimHash of a whole text, from XXH64 of its word shingles, repeats included."""
    found = (text or "").encode().lower().split()
    if not found:
        return 0
    starts = range(max(1, len(found) - words + 1))
    ones = np.zeros(64, np.int64)
    for first in range(0, len(starts), HASHED_AT_ONCE):
        part = starts[first: first + HASHED_AT_ONCE]
        hashes = np.array([xxhash.xxh64_intdigest(b" ".join(found[i: i + words]), SEED) for i in part], ">u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(starts)).tobytes(), "big")


def fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, text_hash, fp): the fingerprint as a signed 64-bit number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t, words) for t in batch.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(found.view(np.int64))], ["doc_id", "text_hash", "fp"])

    return docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("text_hash")).mapInArrow(
        run, "doc_id long, text_hash long, fp long")


def block_choices(distinct: int, most_bits: int = MOST_BITS) -> list[int]:
    """Masks so that two fingerprints within ``most_bits`` bits agree under at least one of them.

    The 64 bits are cut into b blocks; at most ``most_bits`` blocks differ, so b - most_bits agree. More blocks give
    longer keys, and b grows with the number of fingerprints so that chance meetings per fingerprint stay few.
    """
    for blocks in range(most_bits + 1, 33):
        edges = np.linspace(0, 64, blocks + 1).astype(int)
        parts = [((1 << int(hi)) - 1) ^ ((1 << int(lo)) - 1) for lo, hi in zip(edges, edges[1:], strict=False)]
        masks = [sum(c) for c in combinations(parts, blocks - most_bits)]
        if min(m.bit_count() for m in masks) >= np.log2(max(distinct, 2)) + 2 or blocks - most_bits >= 4:
            return masks
    raise AssertionError


def _distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def links(distinct: DataFrame, most_bits: int = MOST_BITS) -> DataFrame:
    """Edges (a, b) between fingerprints; two fingerprints are connected by them exactly when a chain of fingerprints
    within ``most_bits`` bits connects them.

    Fingerprints meet in buckets: equal bits under one of the masks. In buckets of up to ``COMPARED`` fingerprints all
    meetings are verified. A larger bucket (a large group of near copies) would give pairs with the square of its
    size; there each fingerprint is written under every value within half the distance of it instead, and joined to
    the smallest fingerprint that shares the value. Two values at distance d share such a midpoint exactly when
    d <= most_bits, so the links are the same, and their number is in proportion to the bucket.
    """
    masks = block_choices(distinct.count(), most_bits)
    keys = F.array(*[F.struct(F.lit(i).alias("mask"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("bits"))
                     for i, m in enumerate(masks)])
    keyed = settle("blocks", distinct.select("fp", F.explode(keys).alias("k")).select("fp", "k.mask", "k.bits"))
    sizes = keyed.groupBy("mask", "bits").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    small = keyed.join(sizes.filter(F.col("n") <= COMPARED), ["mask", "bits"]).drop("n")
    verified = (
        small.select("mask", "bits", F.col("fp").alias("a")).join(small.withColumnRenamed("fp", "b"), ["mask", "bits"])
        .filter((F.col("a") > F.col("b")) & (_distance(F.col("a"), F.col("b")) <= most_bits))
        .select("a", "b")
    )
    crowded = keyed.join(sizes.filter(F.col("n") > COMPARED), ["mask", "bits"], "left_semi").select("fp").distinct()
    return verified.union(_through_midpoints(settle("crowded", crowded), most_bits))


def _through_midpoints(crowded: DataFrame, most_bits: int) -> DataFrame:
    half = (most_bits + 1) // 2
    flips = np.array([sum(1 << i for i in c) for n in range(half + 1) for c in combinations(range(64), n)], np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(0).to_numpy().view(np.uint64)
            for first in range(0, len(fps), 256):
                part = fps[first: first + 256]
                middle = (part[:, None] ^ flips[None, :]).ravel()
                order = np.argsort(middle, kind="stable")
                middle, source = middle[order], np.repeat(part, len(flips))[order]
                starts = np.flatnonzero(np.r_[True, middle[1:] != middle[:-1]])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(middle.view(np.int64)), pa.array(source.view(np.int64))], ["middle", "fp"])
                del starts

    at = crowded.mapInArrow(run, "middle long, fp long")
    lowest = at.groupBy("middle").agg(F.min("fp").alias("b"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    found = at.join(lowest, "middle").filter("fp <> b")
    if most_bits % 2:  # the midpoint reaches one bit too far for odd distances
        raise ValueError("crowded buckets need an even distance")
    return found.select(F.col("fp").alias("a"), "b").distinct()


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def near_duplicates(docs: DataFrame, words: int = SHINGLE_WORDS, most_bits: int = MOST_BITS) -> DataFrame:
    """One row per document: doc_id, text_hash, fingerprint (16 hex digits), component_id (smallest id reachable)."""
    rows = settle("fingerprints", fingerprints(docs, words))
    distinct = settle("distinct-fingerprints", rows.groupBy("fp").agg(F.min("doc_id").alias("first")))
    found = components(links(distinct.select("fp"), most_bits))
    rooted = distinct.join(found.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))
    lowest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = rooted.join(lowest, "root").select("fp", "component_id")
    return rows.join(named, "fp").select(
        "doc_id", "text_hash", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
