"""Benchmark decontamination: which documents contain (most of) a test item.

Items are partitioned by size (number of distinct word shingles, by powers of two). Each partition keeps a MinHash
sketch of every item, its smallest shingle hashes. A document is searched with *all* its shingle hashes, not with a
sketch of its own: a test item makes up a thousandth of a long document, and a sketch of the document would miss it.
A document with at least the threshold of an item's shingles misses all k of the item's smallest only if they are all
among the missing ones, at k = 16 and 0.8 with probability below 0.2 ** 16. Candidates are verified by exact
containment of the shingles themselves.

Defined cases: texts are compared lower-cased (A-Z) as words; a null or empty text contains nothing, and an item
without words is contained nowhere. A text with fewer words than a shingle is one shingle. Rows that repeat are judged
each on its own. An empty table on either side gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casewright.llm.common import text_bytes, word_count
from casewright.llm.words import shingle_hashes, words_of

SHINGLE_WORDS = 5
CONTAINED = 0.8
SKETCH = 16
SHINGLE_LIMIT = 1 << 30
#: Words of test items held by a task at a time, some 100 bytes each; a larger benchmark is searched in blocks.
BLOCK_WORDS = 500_000


def shingles(text: str | None, words: int = SHINGLE_WORDS) -> set[bytes]:
    found = (text or "").encode().lower().split()
    if not found:
        return set()
    return {b" ".join(found[i: i + words]) for i in range(max(1, len(found) - words + 1))}


class Sketches:
    """The sketches of a block of items, by size partition."""

    def __init__(self, items: list[tuple[int, str | None]], words: int, contained: float, sketch: int) -> None:
        self.words, self.contained = words, contained
        self.items = [(item, s) for item, text in items if (s := shingles(text, words))]
        partitions: dict[int, list[int]] = defaultdict(list)
        for at, (_, s) in enumerate(self.items):
            partitions[len(s).bit_length()].append(at)
        #: (smallest number of shingles that a document needs, sorted hashes, item of each hash)
        self.partitions = []
        for level, members in sorted(partitions.items()):
            rows = sorted(
                (h, at) for at in members for h in sorted(_hashes(self.items[at][1]))[:sketch])
            self.partitions.append((
                int(np.ceil(contained * (1 << (level - 1)))),
                np.array([h for h, _ in rows], np.uint64), np.array([at for _, at in rows], np.int64)))

    def candidates(self, hashes: np.ndarray, rows: np.ndarray, n_rows: int) -> dict[int, set[int]]:
        """Items that may be contained, by row, from all shingle hashes with the row of each."""
        found: dict[int, set[int]] = defaultdict(set)
        counts = np.bincount(rows, minlength=n_rows) if len(rows) else np.zeros(n_rows, np.int64)
        for least, known, owner in self.partitions:
            at = np.searchsorted(known, hashes)
            at[at == len(known)] = 0
            hit = np.flatnonzero((known[at] == hashes) & (counts[rows] >= least))
            for row, first, value in zip(rows[hit].tolist(), at[hit].tolist(), hashes[hit].tolist(), strict=True):
                while first < len(known) and int(known[first]) == value:
                    found[row].add(int(owner[first]))
                    first += 1
        return found


def _hashes(found: set[bytes]) -> list[int]:
    listed = sorted(found)
    offsets = np.cumsum([0, *map(len, listed)])
    words = words_of(np.frombuffer(b"".join(listed), np.uint8), offsets)
    return shingle_hashes(words, SHINGLE_LIMIT)[0].tolist()


def contained_items(docs: DataFrame, items: DataFrame, words: int = SHINGLE_WORDS, contained: float = CONTAINED,
                    sketch: int = SKETCH, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(doc_id, text_hash, item_id, shared, item_shingles) for each document that contains at least ``contained`` of an
    item's distinct shingles.

    The items are the query set. They are taken in blocks of bounded size, so what a task holds does not grow with the
    benchmark.
    """
    spark = docs.sparkSession
    sized = items.select(F.col("item_id").cast("long").alias("item_id"), "text", word_count(F.col("text")).alias("n"))
    total = sized.agg(F.sum("n")).first()[0] or 0
    blocks = -(-int(total) * 2 // block_words) or 1
    found = None
    for block in range(blocks):
        part = sized.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).select("item_id", "text")
        held = spark.sparkContext.broadcast(Sketches(
            [(r.item_id, r.text) for r in part.toLocalIterator()], words, contained, sketch))
        more = docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("text_hash")).mapInArrow(
            _search(held), "doc_id long, text_hash long, item_id long, shared int, item_shingles int")
        found = more if found is None else found.union(more)
    return found


def _search(held) -> object:
    schema = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("item_id", pa.int64()),
                        ("shared", pa.int32()), ("item_shingles", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: Sketches = held.value
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            found = words_of(data, offsets, lower=True)
            hashes, rows = shingle_hashes(found, known.words)
            out = []
            for row, items in known.candidates(hashes, rows, batch.num_rows).items():
                own = shingles(batch.column(1)[row].as_py(), known.words)
                for at in items:
                    item, wanted = known.items[at]
                    shared = len(wanted & own)
                    if shared >= known.contained * len(wanted):
                        out.append({"doc_id": batch.column(0)[row].as_py(), "text_hash": batch.column(2)[row].as_py(),
                                    "item_id": item, "shared": shared, "item_shingles": len(wanted)})
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    return run
