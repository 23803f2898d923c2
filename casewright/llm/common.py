"""Small helpers that several operators share."""

from __future__ import annotations

import gc
import time
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casewright.session import settle

__all__ = ["ascii_lower", "by_rows", "documents", "release", "settle", "table", "text_bytes", "word_count"]

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents")


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z, every other character unchanged."""
    return F.translate(text, UPPER, LOWER)


def word_count(text: Column) -> Column:
    """Number of runs of characters other than space and U+0009 to U+000D; null counts 0."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner delete the shuffle files of tables that are written down and no longer referenced.

    The cleaner acts when the driver's JVM has found them unreachable, which takes a round for Python's proxies and one
    for what they held.
    """
    for _ in range(3):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.3)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """One buffer with the bytes of all texts, and their offsets in it. Null texts are empty."""
    text = column.fill_null("").cast(pa.large_binary())
    offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset: text.offset + len(text) + 1]
    data = text.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    if not len(text):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    return data[int(offsets[0]): int(offsets[-1])], offsets - offsets[0]


def by_rows(rows: Callable[[pa.RecordBatch], Iterator[dict]], schema: pa.Schema, size: int = 2000) -> Callable:
    """A function for ``mapInArrow`` that turns each batch into rows, written out ``size`` at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for batch in batches:
            for row in rows(batch):
                held.append(row)
                if len(held) >= size:
                    yield pa.RecordBatch.from_pylist(held, schema=schema)
                    held = []
        if held:
            yield pa.RecordBatch.from_pylist(held, schema=schema)

    return run
