"""Mixing sources to target weights by weighted fair queueing.

Every document waits in its source's queue, in shuffled order. A source with target t is served at rate t, so a
document finishes at virtual time (words of its source up to and with it) / t. A source whose target exceeds its size queues its
documents again, up to three times. Copies are range-sorted by finish time over all sources; sums per range give every copy
the words that are mixed before it, and the mix ends where the budget is reached. All sources are busy until then, so
documents in service at that time are taken in part.

Defined cases: a null text has no words. The null source comes last by code point. Rows that repeat an id are queued as
separate rows; wholly equal rows stand next to each other and their order does not matter. Ties in the shuffle key
are ordered by id and text hash. A source without words gets target 0 and an empty table gives an empty result. Other
columns are not read, and names cannot clash with them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casewright.llm.common import settle, word_count

WEIGHTS = (1, 2, 3)
PASSES = 3
SEED = "mix-1"
#: Hex digits of the shuffle key that cut a source's queue into stretches, each summed by a task of its own.
STRETCH_DIGITS = 3


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, passes: int = PASSES) -> DataFrame:
    """(source, source_size, target) from (source, size) rows: a share of all words by weight, at most ``passes``
    times the source's size, the excess reshared by weight until no target is above.

    Resharing ends at target = least(passes * size, level * weight) for one level. Sources fill up in the order of
    passes * size / weight, so the level is that of the first prefix after which no further source fills up. The
    windows run over one row per source, which is the number of sources and not of documents.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    in_order = Window.orderBy(F.col("source").asc_nulls_last())
    place = (F.row_number().over(in_order) - 1) % len(weights)
    weighed = totals.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), place + 1))
    filled = weighed.withColumn("full_at", passes * F.col("source_size") / F.col("weight"))
    everything = Window.partitionBy()
    ordered = Window.orderBy("full_at", F.col("source").asc_nulls_last())
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    level = (
        filled.withColumn("budget", F.sum("source_size").over(everything))
        .withColumn("left", F.col("budget") - F.coalesce(F.sum(passes * F.col("source_size")).over(before), F.lit(0)))
        .withColumn("open", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
        .withColumn("level", F.col("left") / F.col("open"))
        .withColumn("level", F.min(F.when(F.col("level") <= F.col("full_at"), F.struct("full_at", "level")))
                    .over(everything)["level"])
    )
    cap = (passes * F.col("source_size")).cast("double")
    return level.select("source", "source_size", F.coalesce(
        F.least(cap, F.col("level") * F.col("weight")), cap).alias("target"))


def queue(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, passes: int = PASSES, seed: str = SEED) -> DataFrame:
    """One row per document: doc_id, text_hash, source, size, source_size, target, and ``words_before``: the words of
    its source that are queued before it.

    A queue is cut into stretches by the leading digits of the shuffle key. Sums run inside stretches, and over one row
    per stretch, so no task holds a whole source.
    """
    key = F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.lit(seed)))
    rows = settle("sizes", docs.select(
        "doc_id", F.xxhash64("text").alias("text_hash"), F.col("source").cast("string").alias("source"),
        word_count(F.col("text")).alias("size"), key.alias("key"), F.substring(key, 1, STRETCH_DIGITS).alias("stretch")))
    targets = source_targets(rows, weights, passes)
    stretches = rows.groupBy("source", "stretch").agg(F.sum("size").alias("stretch_size"))
    up_to = Window.partitionBy("source").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stretches.select(
        "source", "stretch", F.coalesce(F.sum("stretch_size").over(up_to), F.lit(0)).alias("offset")).alias("o").join(
        targets.alias("t"), F.col("o.source").eqNullSafe(F.col("t.source"))).select("o.*", "t.source_size", "t.target")
    inside = Window.partitionBy("source", "stretch").orderBy("key", "doc_id", "text_hash", "size").rowsBetween(
        Window.unboundedPreceding, -1)
    summed = rows.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    same = F.col("r.source").eqNullSafe(F.col("o.source")) & (F.col("r.stretch") == F.col("o.stretch"))
    return summed.alias("r").join(offsets.alias("o"), same).select(
        "r.doc_id", "r.text_hash", "r.source", "r.size", "o.source_size", "o.target",
        (F.col("r.inside") + F.col("o.offset")).alias("words_before"))


def _served(passes: int, until: float) -> Column:
    """The copies of a row that are served by virtual time ``until``: number, virtual finish time, words."""
    share = F.floor(F.col("target") * F.lit(until) + 0.5)

    def copy(n: int) -> Column:
        start = F.col("words_before") + n * F.col("source_size")
        return F.struct(
            F.lit(n + 1).alias("copy"), ((start + F.col("size")) / F.col("target")).alias("finish"),
            F.least(F.col("size"), F.greatest(share - start, F.lit(0))).cast("long").alias("words"))

    return F.filter(F.array(*[copy(n) for n in range(passes)]), lambda c: c["words"] > 0)


def _mixed(queued: DataFrame, passes: int, share: float) -> DataFrame:
    """The copies in the mix: source, words_before, doc_id, text_hash, copy, finish, words.

    ``queued`` is a written table. The copies are range-partitioned by finish time; the words before a copy are those of earlier
    ranges, of which there is one row each, and of earlier copies of its range.
    """
    due = F.floor(F.col("target") * F.lit(share) + 0.5)
    budget = queued.groupBy("source").agg(F.max(due).alias("due")).agg(F.sum("due")).first()[0] or 0
    order = ["finish", "doc_id", "text_hash", "copy"]
    copies = queued.select("source", "words_before", "doc_id", "text_hash", F.inline(_served(passes, share)))
    ranged = settle("mix-order", copies.repartitionByRange(*order).withColumn("piece", F.spark_partition_id()))
    up_to = Window.orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    pieces = ranged.groupBy("piece").agg(F.sum("words").alias("n")).select(
        F.col("piece").alias("of"), F.coalesce(F.sum("n").over(up_to), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("piece").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    placed = ranged.withColumn("before", F.coalesce(F.sum("words").over(inside), F.lit(0))).join(
        F.broadcast(pieces), F.col("piece") == F.col("of"))  # a row per partition
    left = F.lit(budget) - F.col("before") - F.col("offset")
    return placed.filter(left > 0).select(
        "source", "words_before", "doc_id", "text_hash", "copy", "finish", F.least("words", left).cast("long").alias("words"))


def schedule(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, passes: int = PASSES, seed: str = SEED,
             share: float = 1.0, ordered: bool = True) -> DataFrame:
    """The mix in order: doc_id, text_hash, copy, finish, words, sorted by virtual finish time and cut at the budget.

    ``share`` is the part of all targets to take. ``ordered=False`` leaves the rows in the order of a join, for results that are
    joined on; which rows they are is the same.
    """
    mix = _mixed(settle("queue", queue(docs, weights, passes, seed)), passes, share).select("doc_id", "text_hash", "copy", "finish", "words")
    return mix.orderBy("finish", "doc_id", "text_hash", "copy") if ordered else mix


def taken_words(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, passes: int = PASSES, seed: str = SEED,
                share: float = 1.0) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken (words of all its copies in the mix)."""
    queued = settle("queue", queue(docs, weights, passes, seed))
    # Among documents with words, the words before one in its queue tell it from all others of its source.
    taken = _mixed(queued, passes, share).groupBy("source", "words_before").agg(F.sum("words").alias("words"))
    same = F.col("q.source").eqNullSafe(F.col("t.source")) & (F.col("q.words_before") == F.col("t.words_before")) & (F.col("q.size") > 0)
    return queued.alias("q").join(taken.alias("t"), same, "left").select(
        "q.doc_id", "q.size", "q.source_size", "q.target", F.coalesce("t.words", F.lit(0)).cast("long").alias("taken"))
