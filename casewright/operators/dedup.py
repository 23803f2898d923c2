"""Keep-first, first-row fill and group counts, each with a stated total order.

None of these gathers a group in one task. Keep-first is a ``row_number() = 1`` filter, which Spark
applies once before the shuffle (a group limit per map task) and once after it, so a key holding a
third of all rows still shuffles at most one row per map task. Fill and count aggregate first
(partial aggregation) and join the one row per key back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from casewright.operators.joins import attach


def keep_first(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """One row per key: the first in ``order``, which should be total."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn("_rank", F.row_number().over(window))
        .filter(F.col("_rank") == 1)
        .drop("_rank")
    )


def with_group_count(df: DataFrame, key: str, name: str, uid: str) -> DataFrame:
    """Attach the size of the row's group."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias(name))
    return attach(df, counts, key, uid)


def fill_from_first_row(df: DataFrame, group: str, row_no: str, columns: list[str]) -> DataFrame:
    """Blank cells take the value their group's first row has in the same column."""
    first = df.groupBy(group).agg(
        *[F.min_by(F.col(c), F.col(row_no)).alias(f"_first_{c}") for c in columns]
    )
    joined = df.join(first, group, "left")
    filled = {c: F.when(F.length(c) > 0, F.col(c)).otherwise(F.col(f"_first_{c}"))
              for c in columns}
    return joined.select(*[filled.get(c, F.col(c)).alias(c) for c in df.columns])
