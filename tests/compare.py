"""Side-by-side comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import datetime
import math

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
               "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def duck(folder: str):
    import duckdb
    con = duckdb.connect()
    for table in BASE_TABLES:
        con.execute(f"create view {table} as select * from '{folder}/{table}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9) + 0.0
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = [tuple(_cell(row[i]) for i in order) for row in rows]
    return sorted(lines, key=repr)


def differences(spark_df, con, sql: str) -> list[str]:
    """What differs; empty when the results agree in columns, types and values."""
    relation = con.sql(sql)
    spark_columns, duck_columns = spark_df.columns, relation.columns
    if sorted(spark_columns) != sorted(duck_columns):
        return [f"columns {sorted(set(spark_columns) ^ set(duck_columns))}"]
    spark_rows, duck_rows = spark_df.collect(), relation.fetchall()
    ours, theirs = normal(spark_columns, spark_rows), normal(duck_columns, duck_rows)
    out = []
    if len(ours) != len(theirs):
        out.append(f"rows {len(ours)} against {len(theirs)}")
    for a, b in zip(ours, theirs):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            out.append(f"first difference {a} against {b}")
            break
    spark_types = dict(spark_df.dtypes)
    for name, dtype in zip(duck_columns, relation.dtypes):
        want = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string",
                "BOOLEAN": "boolean", "DATE": "date"}.get(str(dtype), str(dtype))
        if want == '"NULL"' or want == "NULL":
            continue
        if spark_types[name] != want:
            out.append(f"type of {name}: {spark_types[name]} against {dtype}")
    return out
