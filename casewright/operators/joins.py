"""Joins with fixed rules for blank keys and for right sides with one row per key.

No join carries a broadcast hint on data that grows: Spark broadcasts a side only while its measured
size is under ``spark.sql.autoBroadcastJoinThreshold``, and adaptive execution splits skewed
partitions of the left side otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from casewright.functions.text import blank_to_null


def spread_key(key: str, uid: str) -> Column:
    """Join key that keeps blank keys apart.

    Blank and null keys match nothing, yet a shuffle would send all of them to one task. Giving
    each its own never-matching key spreads them evenly.
    """
    return F.coalesce(blank_to_null(key), F.concat(F.lit("\u0001"), F.coalesce(F.col(uid).cast("string"), F.lit(""))))


def attach(left: DataFrame, right: DataFrame, key: str, uid: str,
           right_key: str | None = None) -> DataFrame:
    """Left join to a table with one row per text key; blank keys find nothing."""
    return attach_all(left, [(right, right_key or key)], key, uid)


def attach_all(left: DataFrame, rights: list[tuple[DataFrame, str]], key: str, uid: str) -> DataFrame:
    """``attach`` for several tables, given with the name of their key, on one key of ``left``: its rows are shuffled once for all.

    No key of ``left`` is blank (``spread_key``), so the tables are not searched for blank ones: Spark would do that below their
    own joins, on every row they are made of, and work the key out again each time.
    """
    out = left.withColumn("_left_key", spread_key(key, uid))
    for right, right_key in rights:
        values = [c for c in right.columns if c != right_key]
        keyed = right.select(F.col(right_key).alias("_right_key"), *values)
        out = out.join(keyed, F.col("_left_key") == F.col("_right_key"), "left").drop("_right_key")
    return out.drop("_left_key")


def rows_in(df: DataFrame, others: DataFrame, key: str, other_key: str | None = None) -> DataFrame:
    """Rows whose key occurs in the other table; null keys never match."""
    keys = others.select(F.col(other_key or key).alias(key)).filter(F.col(key).isNotNull())
    return df.join(keys, key, "left_semi")


def rows_not_in(df: DataFrame, others: DataFrame, key: str, other_key: str | None = None,
                null_matches: bool = False) -> DataFrame:
    """Rows whose key does not occur in the other table.

    Null keys are kept, unless ``null_matches`` lets a null on the other side remove them.
    """
    keys = others.select(F.col(other_key or key).alias("_other_key"))
    if null_matches:
        return df.join(keys, F.col(key).eqNullSafe(F.col("_other_key")), "left_anti")
    return df.join(keys.filter(F.col("_other_key").isNotNull()),
                   F.col(key) == F.col("_other_key"), "left_anti")


def full_outer(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Full outer join on one key column; rows of either side without partner stay."""
    return left.join(right, key, "full")


def shared_inner(left: DataFrame, right: DataFrame) -> DataFrame:
    """Inner join on every column name both tables have."""
    shared = [c for c in left.columns if c in right.columns]
    if not shared:
        raise ValueError("the tables share no column")
    return left.join(right, shared, "inner")


def right_wins(left: DataFrame, right: DataFrame, key: str, columns: list[str],
               how: str = "left") -> DataFrame:
    """Join on ``key``; the named columns come from the right table, also where it has none."""
    renamed = right.select(key, *[F.col(c).alias(f"_right_{c}") for c in columns])
    joined = left.join(renamed, key, how)
    kept = [F.col(f"_right_{c}").alias(c) if c in columns else F.col(c) for c in left.columns]
    added = [F.col(f"_right_{c}").alias(c) for c in columns if c not in left.columns]
    return joined.select(*kept, *added)
