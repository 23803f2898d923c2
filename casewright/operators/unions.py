"""Unions by name, by position, with a winning side, and insert-if-absent."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from casewright.operators.dedup import keep_first
from casewright.operators.joins import rows_not_in


def by_name(*tables: DataFrame) -> DataFrame:
    """All rows; columns a table lacks are null."""
    out = tables[0]
    for table in tables[1:]:
        out = out.unionByName(table, allowMissingColumns=True)
    return out


def by_position(first: DataFrame, *others: DataFrame) -> DataFrame:
    """All rows under the first table's column names."""
    out = first
    for other in others:
        if len(other.columns) != len(first.columns):
            raise ValueError("tables differ in their number of columns")
        out = out.union(other)
    return out


def conform(df: DataFrame, columns) -> DataFrame:
    """Exactly these columns, as text; missing ones are null."""
    have = set(df.columns)
    return df.selectExpr(*[f"cast({c if c in have else 'null'} as string) as {c}" for c in columns])


def first_table_wins(tables: list[DataFrame], key: str,
                     order: list[Column | str] = ()) -> DataFrame:
    """One row per key; of equal keys the earliest table's row stays."""
    ranked = [t.withColumn("_table", F.lit(i)) for i, t in enumerate(tables)]
    rest = list(order) or [c for c in tables[0].columns if c != key]
    return keep_first(by_name(*ranked), [key], ["_table", *rest]).drop("_table")


def insert_if_absent(existing: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """The new rows whose key the existing table lacks (what an append should write)."""
    return rows_not_in(new.filter(F.col(key).isNotNull()), existing, key)
