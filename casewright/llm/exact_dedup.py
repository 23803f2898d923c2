"""Exact duplicates by content-defined chunk recipes.

Each text is cut where the bytes themselves say so, each chunk is named once for the whole corpus, and texts are
compared as ordered lists of chunk names. The long texts are read once and never shuffled: what moves is some 60
bytes a chunk of about 2 KB.

Defined cases: a null text is an empty text (a recipe of no chunks). Texts are equal when identical after lower-casing
A-Z. Rows that repeat both the id and the normalised text are one document and give one row; rows that share an id but
not the text are two documents. A null id is smaller than every other id. An empty table gives an empty result. Other
columns of the input are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from casewright.llm.common import by_rows, settle

CHUNK_BITS = 11
LONGEST_CHUNK = 1 << 16
MIX = np.uint64(0x9E3779B97F4A7C15)

_ARROW = pa.schema([
    ("doc_id", pa.int64()), ("text_sha256", pa.string()),
    ("chunks", pa.list_(pa.struct([("at", pa.int32()), ("name", pa.int64()), ("check", pa.binary())]))),
])
_SPARK = "doc_id long, text_sha256 string, chunks array<struct<at: int, name: long, check: binary>>"


def chunk_ends(data: bytes, bits: int = CHUNK_BITS, longest: int = LONGEST_CHUNK) -> list[int]:
    """Ends of the chunks of ``data``: after each byte whose last eight bytes hash to zero in ``bits`` bits, so that
    equal stretches are cut alike wherever they stand; longer gaps are cut every ``longest`` bytes."""
    if not data:
        return []
    ends = []
    if len(data) > 8:
        rolled = np.frombuffer(data, np.uint8).astype(np.uint64)
        for step in (1, 2, 4):
            rolled = rolled[:-step] << np.uint64(8 * step) | rolled[step:]
        ends = (np.flatnonzero((rolled * MIX) >> np.uint64(64 - bits) == 0) + 8).tolist()
    if not ends or ends[-1] != len(data):
        ends.append(len(data))
    cut, start = [], 0
    for end in ends:
        cut.extend(range(start + longest, end, longest))
        cut.append(end)
        start = end
    return cut


def _recipes(batch: pa.RecordBatch) -> Iterator[dict]:
    for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
        data = (text or "").encode().lower()
        chunks, start = [], 0
        for at, end in enumerate(chunk_ends(data)):
            piece = data[start:end]
            chunks.append({"at": at, "name": xxhash.xxh3_64_intdigest(piece) - (1 << 63),
                           "check": hashlib.blake2b(piece, digest_size=24).digest()})
            start = end
        yield {"doc_id": doc_id, "text_sha256": hashlib.sha256(data).hexdigest(), "chunks": chunks}


def recipes(docs: DataFrame) -> DataFrame:
    """(doc_id, text_sha256, recipe) for each document; ``recipe`` lists the verified chunk identifiers in order.

    A chunk is named by a 64-bit hash. Names are verified by a second, independent digest: where one name stands for
    several contents, these are told apart by their rank, so an identifier means one content only.
    """
    raw = settle("recipes", docs.select(F.col("doc_id").cast("long"), "text")
                 .mapInArrow(by_rows(_recipes, _ARROW), _SPARK).dropDuplicates(["doc_id", "text_sha256"]))
    listed = raw.select("doc_id", "text_sha256", F.explode("chunks").alias("c")).select("doc_id", "text_sha256", "c.*")
    # Written down: it is (all but) empty, and so the joins with it need no shuffle by name, of which some are very hot.
    several = settle("names-in-doubt", listed.groupBy("name").agg(
        F.min("check").alias("low"), F.max("check").alias("high")).filter("low <> high").select("name"))
    # Ranks exist only for the names in doubt; all others have rank 0.
    ranks = (
        listed.join(several, "name", "left_semi").select("name", "check").distinct()
        .select("name", "check", F.rank().over(Window.partitionBy("name").orderBy("check")).alias("rank"))
    )
    doubtful = (
        listed.join(ranks, ["name", "check"])
        .groupBy("doc_id", "text_sha256").agg(F.map_from_entries(F.collect_list(F.struct("at", "rank"))).alias("ranks"))
    )
    name = lambda c: F.struct(c["name"].alias("name"), F.coalesce(F.col("ranks")[c["at"]], F.lit(0)).alias("rank"))
    same = F.col("r.doc_id").eqNullSafe(F.col("d.doc_id")) & (F.col("r.text_sha256") == F.col("d.text_sha256"))
    return raw.alias("r").join(doubtful.alias("d"), same, "left").select(
        "r.doc_id", "r.text_sha256", F.transform("chunks", name).alias("recipe"))


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, keep_id (largest id of the equal texts), group_size, kept, text_sha256."""
    rows = recipes(docs)
    # The list itself is compared; the digest only decides where it is compared. The groups are written down, so that
    # the join below is a plain join of two tables, whose hot keys Spark can split.
    groups = settle("groups", rows.groupBy("text_sha256", "recipe").agg(
        F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")))
    found = rows.join(groups, ["text_sha256", "recipe"])
    return found.select("doc_id", "keep_id", "group_size",
                        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")
